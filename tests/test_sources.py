import datetime as dt

import pytest
from conftest import same_rows
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from tallyloom import schemas, sources


def test_reads_path_table_and_frame(spark, make_sales, new_path):
    sales = make_sales((1, 2, 3, 4.5, "completed", "2024-01-01 10:00:00"))
    sales.write.parquet(new_path)
    sales.createOrReplaceTempView("some_sales")
    for source in (sales, new_path, "some_sales"):
        assert same_rows(sources.read_sales(spark, source), sales)


def test_columns_are_selected_and_ordered(spark, make_orders):
    orders = make_orders((1, 2, 3, "2024-01-01"))
    shuffled = orders.select(F.lit(1).alias("more"), *reversed(orders.columns))
    assert sources.read_orders(spark, shuffled).schema == schemas.ORDERS


def test_integers_and_decimals_are_widened(spark, make_orders):
    orders = make_orders((1, 2, 3, "2024-01-01"))
    narrow = orders.withColumn("customer_id", F.lit(7)).withColumn(
        "order_amount", F.col("order_amount").cast("decimal(22,4)")
    )
    got = dict(sources.read_orders(spark, narrow).dtypes)
    assert (got["customer_id"], got["order_amount"]) == ("bigint", "decimal(22,4)")


def test_dates_become_midnights(spark, make_orders):
    orders = make_orders((1, 2, 3, "2024-01-05"))
    dated = orders.withColumn("order_date", F.to_date("order_date"))
    assert same_rows(sources.read_orders(spark, dated), orders)


@pytest.mark.parametrize(
    "column, kind", [("order_amount", "double"), ("order_date", "timestamp"), ("order_id", "string")]
)
def test_other_types_are_refused(spark, make_orders, column, kind):
    orders = make_orders((1, 2, 3, "2024-01-01"))
    with pytest.raises(sources.SchemaMismatch, match=column):
        sources.read_orders(spark, orders.withColumn(column, F.col(column).cast("string").cast(kind)))


def test_missing_column_is_named(spark, make_orders):
    orders = make_orders((1, 2, 3, "2024-01-01")).drop("order_status")
    with pytest.raises(sources.SchemaMismatch, match="order_status"):
        sources.read_orders(spark, orders)


def test_table_name():
    assert sources.table_name("dev", "sales") == "`dev`.`sales`"
    assert sources.table_name("dev", "sales", "lake") == "`lake`.`dev`.`sales`"
    with pytest.raises(ValueError):
        sources.table_name("dev", "sales", "lake;drop")
    for bad in ("a.b", "a`b", "", "a b", "1a", "a\n"):
        with pytest.raises(ValueError):
            sources.table_name("dev", bad)


def test_jdbc_slices_cover_the_days_once():
    slices = sources.jdbc_day_slices(dt.date(2024, 1, 1), dt.date(2024, 1, 3), 2)
    assert slices == [
        "created_at >= TIMESTAMP '2024-01-01 00:00:00' AND created_at < TIMESTAMP '2024-01-01 12:00:00'",
        "created_at >= TIMESTAMP '2024-01-01 12:00:00' AND created_at < TIMESTAMP '2024-01-02 00:00:00'",
        "created_at >= TIMESTAMP '2024-01-02 00:00:00' AND created_at < TIMESTAMP '2024-01-02 12:00:00'",
        "created_at >= TIMESTAMP '2024-01-02 12:00:00' AND created_at < TIMESTAMP '2024-01-03 00:00:00'",
    ]
    with pytest.raises(ValueError):
        sources.jdbc_day_slices(dt.date(2024, 1, 1), dt.date(2024, 1, 1), 2)


def test_jdbc_read_is_sliced_and_conformed(spark, make_sales, monkeypatch):
    """Only the call is checked: no database may be started here."""
    calls = []
    table = make_sales((1, 2, 3, 4.5, "completed", "2024-01-01 10:00:00"))

    def jdbc(reader, url, name, predicates, properties):
        calls.append((url, name, len(predicates), properties))
        return table.withColumn("more", F.lit(1))

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    got = sources.read_jdbc_sales(spark, "jdbc:x", "dev.sales", *days, properties={"user": "u"})
    assert same_rows(got, table)
    assert calls == [("jdbc:x", "dev.sales", 48, {"user": "u"})]


def test_scratch_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = sources.scratch_dir(spark), sources.scratch_dir(spark)
    assert first != second and first.startswith(root) and second.startswith(root)


def test_scratch_has_no_fallback(spark):
    class Unset:
        conf = type("Conf", (), {"get": lambda self, key, default: default})()
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sources.scratch_dir(Unset())


def test_the_default_namespace_is_public():
    assert sources.table_name("sales") == "`public`.`sales`"


def test_stage_keeps_types(spark, make_sales, new_path):
    sales = make_sales((1, 123, None, "1.10", "completed", "2024-01-01 10:00:00.000001"))
    staged = sources.stage(sales, new_path)
    assert staged.schema == sales.schema and same_rows(staged, sales)


def test_state_before_the_first_run(spark, new_path):
    for location in (new_path, "no_such_table"):
        target = sources.kpi_target(location)
        assert not sources.exists(spark, target)
        state = sources.read_state(spark, target)
        assert state.schema.names == schemas.KPI_CALENDAR.names
        assert [f.dataType for f in state.schema] == [f.dataType for f in schemas.KPI_CALENDAR]
        assert state.isEmpty()
