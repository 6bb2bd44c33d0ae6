"""Rebuilds that switch a catalog table, and tables bucketed by customer."""

import pytest
from conftest import final_plan, rows, same_rows
from pyspark.sql import functions as F
from test_rebuild import failing, some_orders

from tallyloom import operators as op
from tallyloom import plans, sources
from tallyloom.operators import sinks


@pytest.fixture(params=[None, 8])
def target(request, spark):
    found = sources.kpi_target("switched_kpi", buckets=request.param)
    yield found
    op.drop_target(spark, found)


def two_builds(make_orders):
    old = plans.customer_kpi(some_orders(make_orders), "calendar")
    new = plans.customer_kpi(
        make_orders((1, 1, 100, "2024-01-05"), (None, 9, 5, "2024-07-05"), (3, 8, 5, None)), "calendar"
    )
    return old, new


def folder(spark, target):
    return sources.table_detail(spark, target).folder


def test_readers_see_old_rows_or_new_ones(spark, make_orders, target):
    old, new = two_builds(make_orders)
    op.materialize(old, target)
    reading = sources.read_state(spark, target)
    assert same_rows(reading, old)
    before = folder(spark, target)
    op.materialize(new, target)
    assert folder(spark, target) != before
    assert same_rows(sources.read_state(spark, target), new)
    assert same_rows(reading, old)  # whoever was reading goes on


def test_what_was_before_the_last_rebuild_goes(spark, make_orders, target):
    builds = two_builds(make_orders)
    places = []
    for i in range(4):
        op.materialize(builds[i % 2], target)
        places.append(folder(spark, target))
        assert same_rows(sources.read_state(spark, target), builds[i % 2])
    there = [bool(sources.targets.folders(spark, p)) for p in places]
    assert there == [False, False, True, True] and len(set(places)) == 4


def test_rows_are_written_once(spark, make_orders, target, monkeypatch):
    old, new = two_builds(make_orders)
    op.materialize(old, target)
    monkeypatch.setattr(sinks, "stage", lambda *a: 1 / 0)
    monkeypatch.setattr(sinks, "_replace_partitions", lambda *a: 1 / 0)
    op.materialize(new, target)
    assert same_rows(sources.read_state(spark, target), new)


@pytest.mark.parametrize("early", [True, False])
def test_a_job_that_fails_while_computing(spark, make_orders, target, early):
    old, _ = two_builds(make_orders)
    op.materialize(old, target)
    place = folder(spark, target)
    with pytest.raises(Exception, match="boom"):
        op.materialize(failing(old, early), target)
    assert folder(spark, target) == place
    assert same_rows(sources.read_state(spark, target), old)
    assert sources.targets.folders(spark, sinks._versions(place)[1]) == []


def test_a_job_that_fails_at_the_switch(spark, make_orders, target, monkeypatch):
    old, new = two_builds(make_orders)
    op.materialize(old, target)
    place, sql = folder(spark, target), type(spark).sql

    def no_switch(self, text, *a, **k):
        if "SET LOCATION" in text:
            raise RuntimeError("lost")
        return sql(self, text, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", no_switch)
        with pytest.raises(RuntimeError, match="lost"):
            op.materialize(new, target)
    assert folder(spark, target) == place
    assert same_rows(sources.read_state(spark, target), old)
    assert sources.targets.folders(spark, sinks._versions(place)[1]) == []


def test_a_job_that_fails_after_the_switch(spark, make_orders, target, monkeypatch):
    old, new = two_builds(make_orders)
    op.materialize(old, target)
    op.materialize(old, target)
    with monkeypatch.context() as m:
        m.setattr(sinks, "remove", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            op.materialize(new, target)
    assert same_rows(sources.read_state(spark, target), new)
    op.materialize(old, target)
    assert same_rows(sources.read_state(spark, target), old)
    assert len(sources.targets.folders(spark, sinks._versions(folder(spark, target))[1])) == 2


def test_a_path_that_fails_while_computing_or_moving(spark, make_orders, new_path, monkeypatch):
    old, new = two_builds(make_orders)
    target = sources.kpi_target(new_path)
    op.materialize(old, target)
    for early in (True, False):
        with pytest.raises(Exception, match="boom"):
            op.materialize(failing(old, early), target)
        assert same_rows(sources.read_state(spark, target), old)
    with monkeypatch.context() as m:
        m.setattr(sinks, "move", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            op.materialize(new, target)
    assert same_rows(sources.read_state(spark, target), old)
    op.materialize(new, target)
    assert same_rows(sources.read_state(spark, target), new)
    assert not [x for x in sources.targets.folders(spark, new_path) if x.startswith("_rebuild")]


def test_upserts_and_refreshes_after_a_switch(spark, make_orders, target):
    data = [(1, 1, 100, "2024-01-05"), (None, 2, 50, "2024-03-05"), (2, 3, 70, "2024-02-01")]
    for _ in range(2):
        op.materialize(plans.customer_kpi(make_orders(*data), "calendar"), target)
    orders = make_orders(*data, (1, 4, 9, "2024-03-06"), (7, 5, 9, "2024-04-06"), (None, 6, 9, "2024-03-07"))
    for _ in range(2):
        plans.run_customer_kpi(spark, orders, target)
        assert same_rows(sources.read_state(spark, target), plans.customer_kpi(orders, "calendar"))
    assert [str(m) for m in sources.stored_parts(spark, target)] == [
        "2024-04-01", "2024-03-01", "2024-02-01", "2024-01-01",
    ]


def test_a_table_that_lists_its_partitions_is_rebuilt_in_place(spark, make_orders):
    old, new = two_builds(make_orders)
    old.write.partitionBy("order_month").format("parquet").saveAsTable("listed_kpi")
    target = sources.kpi_target("listed_kpi")
    assert sources.table_detail(spark, target).lists_partitions
    place = folder(spark, target)
    op.materialize(new, target)
    assert same_rows(sources.read_state(spark, target), new) and folder(spark, target) == place
    op.materialize(new.where("customer_id = 1"), target)
    assert same_rows(sources.read_state(spark, target), new.where("customer_id = 1"))
    assert len(sources.stored_parts(spark, target)) == 1
    op.drop_target(spark, target)


# --- buckets -----------------------------------------------------------------------------------


@pytest.fixture
def daily(spark):
    target = sources.daily_target("bucketed_daily", buckets=16)
    stats = spark.range(3000).select(
        F.col("id").alias("customer_id"),
        F.lit(1.0).alias("daily_total"),
        F.lit(1).cast("long").alias("daily_orders"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS INT))").alias("date"),
    )
    op.append(stats, target)
    yield target
    op.drop_target(spark, target)


def test_the_stored_side_of_an_upsert_is_not_shuffled(spark, daily, monkeypatch):
    seen = []
    insert = type(spark.range(1).write).insertInto

    def noted(self, *a, **k):
        seen.append(final_plan(self._df))
        return insert(self, *a, **k)

    monkeypatch.setattr(type(spark.range(1).write), "insertInto", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    batch = sources.read_state(spark, daily).where("date = DATE'2024-01-02' AND customer_id % 5 = 0")
    batch = spark.createDataFrame(batch.collect(), batch.schema).withColumn("daily_total", F.lit(9.0))
    try:
        op.upsert(batch, daily, touching=F.col("date") == F.lit("2024-01-02").cast("date"), unique=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (plan,) = seen
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
    assert "FullOuter" in plan
    found = sources.read_state(spark, daily).where("date = DATE'2024-01-02'")
    assert found.where("daily_total = 9.0").count() == batch.count()
    assert found.count() == 1000


def test_one_file_for_each_bucket_of_a_partition(spark, daily):
    batch = sources.read_state(spark, daily).withColumn("daily_total", F.lit(2.0))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    for _ in range(2):
        assert len(sources.read_state(spark, daily).inputFiles()) <= 3 * 16
        op.upsert(batch, daily)
    assert sources.read_state(spark, daily).where("daily_total = 2.0").count() == 3000


def rows_scanned(df):
    """Rows of all files that were opened, where the reader skips no part of a file."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_point_read_opens_one_bucket_of_each_partition(spark, daily):
    spark.conf.set("spark.sql.parquet.filterPushdown", "false")
    try:
        one = sources.read_state(spark, daily).where("customer_id = 42")
        assert 0 < rows_scanned(one) < 3 * 3000 / 16
        assert rows_scanned(sources.read_state(spark, daily).where("daily_orders = 42")) == 3000
    finally:
        spark.conf.unset("spark.sql.parquet.filterPushdown")
    assert one.count() == 1


def test_other_buckets_are_refused(spark, daily):
    batch = sources.read_state(spark, daily).limit(1)
    for buckets in (None, 4):
        with pytest.raises(ValueError, match="other buckets"):
            op.append(batch, sources.daily_target("bucketed_daily", buckets=buckets))
        with pytest.raises(ValueError, match="other buckets"):
            op.upsert(batch, sources.daily_target("bucketed_daily", buckets=buckets))
    with pytest.raises(ValueError, match="only a catalog table"):
        sources.daily_target("/some/path", buckets=4)


def test_null_keys_in_buckets(spark, make_orders, target):
    data = [(None, 1, 10, "2024-01-05"), (None, 2, 10, "2024-02-05"), (1, 3, 10, "2024-02-05"), (1, 4, 10, None)]
    orders = make_orders(*data)
    for _ in range(3):
        plans.run_customer_kpi(spark, orders, target)
        assert same_rows(sources.read_state(spark, target), plans.customer_kpi(orders, "calendar"))
    assert rows(sources.read_state(spark, target).where("customer_id is null"), "monthly_orders") == [(1,), (1,)]
