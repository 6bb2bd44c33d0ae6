"""Shapes of the physical plans."""

import datetime as dt
import re

import pytest
from conftest import SF_DIR, final_plan
from pyspark.sql import functions as F

from tallyloom import operators as op
from tallyloom import plans, schemas, sources
from tallyloom.checks import bindings
from tallyloom.functions import at_midnight
from tallyloom.operators.sinks import merge


def count(plan, node):
    return len(re.findall(rf"[-+: ]\s*{node}\b", plan))


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "sales")
    bindings.sales(spark, SF_DIR).write.parquet(path)
    return spark.read.schema(schemas.SALES).parquet(path)


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "orders")
    bindings.orders(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def target(spark, orders, tmp_path_factory):
    target = sources.kpi_target(str(tmp_path_factory.mktemp("out") / "kpi"))
    early = orders.where(F.col("order_date") < F.lit(bindings.SPLIT).cast("timestamp_ntz"))
    plans.run_customer_kpi(spark, early, target)
    return target


@pytest.mark.parametrize("lookback", ["active", "calendar"])
def test_full_model_is_one_scan_and_one_window(orders, lookback):
    plan = final_plan(plans.customer_kpi(orders, lookback))
    assert count(plan, "FileScan") == 1
    assert count(plan, "Window") == 1
    assert count(plan, "Exchange") == 3
    assert "Join" not in plan
    assert "EqualTo(order_status,completed)" in plan


@pytest.mark.parametrize("lookback", ["active", "calendar"])
def test_one_range_shuffle_serves_window_and_sort(orders, lookback):
    no_customer = orders.where("order_id % 50 = 0").withColumn("customer_id", F.expr("CAST(null AS BIGINT)"))
    some = orders.unionByName(no_customer)
    plan = final_plan(plans.customer_kpi(orders, lookback, ordered=True))
    assert count(plan, "Window") == 1
    assert count(plan, "Exchange") == 3
    assert len(re.findall(r"Exchange rangepartitioning\(customer_id", plan)) == 1
    got = plans.customer_kpi(some, lookback, ordered=True).collect()
    want = op.sort_kpi(plans.customer_kpi(some, lookback)).collect()
    assert got == want and got[-1].customer_id is None


def test_columns_not_asked_for_cost_nothing(orders):
    plan = final_plan(plans.customer_kpi(orders).select("customer_id", "revenue_segment"))
    assert count(plan, "Window") == 0 and count(plan, "Exchange") == 1
    assert "order_id" not in plan


def test_hot_customers_are_spread_before_the_distinct_count(orders):
    plan = final_plan(plans.customer_kpi(orders))
    first_shuffle = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)[-1]
    assert "order_id" in first_shuffle
    assert "partial_sum" in plan


def test_unique_ids_save_a_shuffle(orders):
    plan = final_plan(plans.customer_kpi(orders, unique_order_id=True))
    assert count(plan, "Exchange") == 2
    assert "partial_count(order_id" in plan


def test_daily_filters_reach_the_scan(sales):
    plan = final_plan(plans.daily_job(sales, dt.date(2024, 1, 10), drop_repeats=False))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(created_at,2024-01-09T00:00)" in pushed
    assert "LessThan(created_at,2024-01-10T00:00)" in pushed
    assert "EqualTo(status,completed)" in pushed
    assert "product_id" not in plan
    assert count(plan, "Exchange") == 1


def test_dropping_repeats_spreads_by_all_columns(sales):
    plan = final_plan(plans.daily_job(sales, dt.date(2024, 1, 10)))
    first_shuffle = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)[-1]
    for column in ("order_id", "customer_id", "product_id", "amount", "created_at"):
        assert column in first_shuffle
    assert "status" not in first_shuffle
    assert "SortAggregate" not in plan


def test_backfill_filter_reaches_the_scan(sales):
    df = plans.daily_backfill(sales, dt.date(2024, 1, 5), dt.date(2024, 1, 9), False)
    assert "GreaterThanOrEqual(created_at,2024-01-04T00:00)" in final_plan(df)
    assert "LessThan(created_at,2024-01-09T00:00)" in final_plan(df)


def test_refresh_prunes_source_and_state(spark, orders, target):
    state = sources.read_state(spark, target)
    plan = final_plan(plans.customer_kpi_incremental(orders, state))
    assert "GreaterThanOrEqual(order_date,1998-06-01T00:00)" in plan
    assert "(order_month#" in plan and ">= 1997-06-01)" in plan
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>", plan)
    older = [read for pruned, read in scans if "< 1997-06-01" in pruned]
    assert older == ["customer_id:bigint"]
    assert "Join" not in plan


def test_dates_as_input_prune_partitions(spark, orders, tmp_path):
    by_day = orders.withColumn("order_date", F.to_date("order_date"))
    by_month = by_day.withColumn("order_date", F.trunc("order_date", "month"))
    by_month.write.partitionBy("order_date").parquet(str(tmp_path / "orders"))
    source = sources.read_orders(spark, str(tmp_path / "orders"))
    recent = source.where(F.col("order_date") >= at_midnight(dt.date(2001, 1, 1)))
    assert re.search(r"PartitionFilters: \[[^\]]*order_date[^\]]*>= 2001-01-01", final_plan(recent))


def test_refresh_sorts_once(spark, orders, target):
    plan = final_plan(plans.customer_kpi_incremental(orders, sources.read_state(spark, target)))
    assert count(plan, "Window") == 2
    assert count(plan, "Sort") == 1


def test_upsert_computes_the_batch_once(spark, orders, target):
    state = sources.read_state(spark, target)
    since = F.col("order_month") >= F.lit(dt.date(1998, 6, 1))
    batch = plans.customer_kpi_incremental(orders, state)
    plan = final_plan(merge(state.where(since), batch, target))
    assert plan.count("order_status:string") == 1
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_backfill_upsert_reuses_the_grouping(spark, sales, tmp_path):
    target = sources.daily_target(str(tmp_path / "daily"))
    op.append(plans.daily_job(sales, dt.date(2024, 1, 10)), target)
    batch = plans.daily_backfill(sales, dt.date(2024, 1, 5), dt.date(2024, 1, 9), False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = final_plan(merge(sources.read_state(spark, target), batch, target))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert count(plan, "Exchange") == 2  # one to group the batch, one for the stored rows


def test_empty_state_folds_away(spark, orders, new_path):
    state = sources.read_state(spark, sources.kpi_target(new_path))
    joined = op.lookup(op.monthly_orders(orders), state, 1, {"monthly_orders": "before"})
    assert "Join" not in final_plan(joined)


def test_no_python_in_any_plan(spark, orders, sales):
    for df in (plans.customer_kpi(orders), plans.daily_table(sales)):
        assert "Python" not in final_plan(df) and "Arrow" not in final_plan(df)
