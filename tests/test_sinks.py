import datetime as dt
from dataclasses import replace

import pytest
from conftest import final_plan, rows, same_rows
from pyspark.sql import functions as F

from tallyloom import operators as op
from tallyloom import schemas, sources

A, B, C = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
COLUMNS = ("customer_id", "daily_total", "daily_orders", "date")


@pytest.fixture(params=["path", "table"])
def target(request, spark, new_path):
    if request.param == "path":
        yield sources.daily_target(new_path)
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS dev")
        yield sources.daily_target(sources.table_name("dev", "customer_daily_stats"))
        spark.sql("DROP TABLE IF EXISTS dev.customer_daily_stats")


@pytest.fixture
def frame(spark):
    return lambda *data: spark.createDataFrame(list(data), schemas.DAILY_STATS)


def stored(spark, target):
    return rows(sources.read_state(spark, target), *COLUMNS)


def test_upsert_inserts_replaces_and_keeps(spark, target, frame):
    op.upsert(frame((1, 1.0, 1, A), (2, 2.0, 2, A), (3, 3.0, 3, B)), target)
    batch = frame((2, 20.0, 20, A), (4, 4.0, 4, A), (1, 9.0, 9, C))
    want = [(1, 1.0, 1, A), (1, 9.0, 9, C), (2, 20.0, 20, A), (3, 3.0, 3, B), (4, 4.0, 4, A)]
    for _ in range(2):
        op.upsert(batch, target)
        assert stored(spark, target) == want


def test_upsert_replaces_values_with_nulls(spark, target, frame):
    op.upsert(frame((1, 1.0, 1, A)), target)
    op.upsert(frame((1, None, 0, A)), target)
    assert stored(spark, target) == [(1, None, 0, A)]


def test_upsert_of_nothing(spark, target, frame):
    op.upsert(frame((1, 1.0, 1, A)), target)
    op.upsert(frame(), target)
    assert stored(spark, target) == [(1, 1.0, 1, A)]


def test_untouched_partitions_keep_their_files(spark, new_path, frame):
    target = sources.daily_target(new_path)
    op.upsert(frame((1, 1.0, 1, A), (1, 2.0, 2, B)), target)

    def files():
        name = F.input_file_name().alias("file")
        return dict(sources.read_state(spark, target).select("date", name).collect())

    old = files()
    op.upsert(frame((1, 5.0, 5, B)), target)
    assert files()[A] == old[A] and files()[B] != old[B]


@pytest.mark.parametrize("first", [True, False])
def test_a_repeated_key_fails(spark, target, frame, first):
    if not first:
        op.upsert(frame((1, 1.0, 1, A)), target)
    with pytest.raises(Exception, match="two rows for one key"):
        op.upsert(frame((1, 1.0, 1, A), (1, 2.0, 2, A)), target)
    if not first:
        assert stored(spark, target) == [(1, 1.0, 1, A)]


def test_a_row_outside_the_named_partitions_fails(spark, target, frame):
    op.upsert(frame((1, 1.0, 1, A), (2, 2.0, 2, B)), target)
    with pytest.raises(Exception, match="outside the partitions"):
        op.upsert(frame((1, 5.0, 5, B)), target, touching=F.col("date") == A)
    assert stored(spark, target) == [(1, 1.0, 1, A), (2, 2.0, 2, B)]


def test_null_keys_where_allowed_are_replaced_not_repeated(spark, target, frame):
    target = replace(target, null_keys=True)
    for total in (1.0, 2.0):
        op.upsert(frame((None, total, 1, A), (1, total, 1, None)), target)
    assert stored(spark, target) == [(1, 2.0, 1, None), (None, 2.0, 1, A)]


@pytest.mark.parametrize("row", [(None, 1.0, 1, A), (1, 1.0, 1, None)])
def test_null_keys_elsewhere_fail(target, frame, row):
    with pytest.raises(Exception, match="a key column is null"):
        op.upsert(frame(row), target)


def test_stored_parts_are_named_without_reading(spark, target, frame):
    assert sources.stored_parts(spark, target) == []
    op.append(frame((1, 1.0, 1, A), (2, 2.0, 2, C), (3, 3.0, 3, None)), target)
    assert sources.stored_parts(spark, target) == [C, A]


def test_a_key_repeated_very_often_is_counted_before_the_shuffle(spark, frame):
    batch = frame((1, 1.0, 1, A)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9))))
    plan = final_plan(op.sinks._require_unique(batch, ("customer_id", "date")))
    assert "partial_count" in plan and "Window" not in plan and "SortAggregate" not in plan


def test_append(spark, target, frame):
    for _ in range(2):
        op.append(frame((1, 1.0, 1, A)), target)
    assert stored(spark, target) == [(1, 1.0, 1, A)] * 2


def test_materialize_drops_what_was_there(spark, target, frame):
    op.materialize(frame((1, 1.0, 1, A), (2, 2.0, 2, B)), target)
    op.materialize(frame((3, 3.0, 3, C)), target)
    assert stored(spark, target) == [(3, 3.0, 3, C)]


def test_a_table_with_another_column_order(spark, frame):
    spark.sql("CREATE DATABASE IF NOT EXISTS dev")
    spark.sql(
        "CREATE TABLE dev.stats (daily_orders BIGINT, daily_total DOUBLE, customer_id BIGINT, "
        "date DATE) USING parquet PARTITIONED BY (date)"
    )
    target = sources.daily_target("dev.stats")
    op.append(frame((1, 2.0, 3, A)), target)
    op.upsert(frame((1, 5.0, 6, A), (7, 8.0, 9, B)), target)
    assert stored(spark, target) == [(1, 5.0, 6, A), (7, 8.0, 9, B)]
    spark.sql("DROP TABLE dev.stats")


def test_require(spark, frame):
    df = frame((1, 1.0, 1, A), (2, 2.0, 2, A))
    assert same_rows(op.require(df, F.col("daily_orders") > 0, "no orders"), df)
    for condition in (F.col("daily_orders") > 1, F.lit(None).cast("boolean")):
        with pytest.raises(Exception, match="no orders"):
            op.require(df, condition, "no orders").collect()


def many_rows(spark, rows, days):
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("customer_id"),
        F.lit(1.0).alias("daily_total"),
        F.lit(1).cast("long").alias("daily_orders"),
        F.expr(f"date_add(DATE'2024-01-01', CAST(id % {days} AS INT))").alias("date"),
    )


def test_one_file_per_partition_value(spark, new_path):
    """Without the gathering, each of the tasks would write into each of the dates."""
    target = sources.daily_target(new_path)
    op.append(many_rows(spark, 1000, 5), target)
    assert len(sources.read_state(spark, target).inputFiles()) == 5


def test_a_large_partition_value_is_split(spark, new_path):
    """All rows fall on one day: they must not end up in one task."""
    target = sources.daily_target(new_path)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "256KB")
    try:
        op.append(many_rows(spark, 1_000_000, 1), target)
    finally:
        spark.conf.unset(size)
    stored = sources.read_state(spark, target)
    assert len(stored.inputFiles()) > 4
    assert stored.count() == 1_000_000
