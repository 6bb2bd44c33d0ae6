"""One query per operator, each over the whole bound tables."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from .. import operators as op
from .. import schemas
from .. import sources as src
from ..plans import (
    customer_kpi,
    daily_table,
    kpi_columns,
    run_customer_kpi,
    run_daily,
    run_daily_backfill,
)
from ..plans import customer_kpi_incremental as refreshed_kpi
from ..functions import at_midnight
from ..plans.daily import LAYOUT_AS_IS, LAYOUT_DEDUPED, ONE_DAY
from ..plans.last_active import last_active_before
from ..plans.late_orders import month_digests
from .bindings import BACKFILL_END, BACKFILL_START, RUN_DATE, SPLIT, orders, sales

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ("customer_id", "order_month")
# An earlier stop of the queries that refresh more than once.
FIRST_SPLIT = dt.date(1996, 3, 10)
REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type the comparison uses for money."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _with_scratch(spark: SparkSession) -> SparkSession:
    """A test session on one machine may name no shared folder; it gets one here."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named and (sc.master == "local" or sc.master.startswith("local[")):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return spark


def before(df: DataFrame, day: dt.date) -> DataFrame:
    return df.where(F.col("order_date") < at_midnight(day))


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = lambda spark, sf_dir: _plain(f(_with_scratch(spark), sf_dir))
    return f


def _done_sales(spark, d):
    return op.completed(sales(spark, d), "status")


def _monthly(spark, d):
    return op.monthly_orders(op.completed(orders(spark, d), "order_status"))


def _before_split(spark, d):
    return orders(spark, d).where(F.col("order_date") < F.lit(SPLIT).cast("timestamp_ntz"))


def _stored_kpi(spark, d) -> src.Target:
    """A KPI table built from the orders before the split."""
    target = src.kpi_target(src.scratch_dir(spark))
    run_customer_kpi(spark, _before_split(spark, d), target)
    return target


def _whole_kpi(spark, d) -> src.Target:
    """A KPI table built from all orders."""
    target = src.kpi_target(src.scratch_dir(spark))
    run_customer_kpi(spark, orders(spark, d), target)
    return target


def _state_and_batch(spark, d):
    state = src.read_state(spark, _stored_kpi(spark, d))
    fresh = op.since_high_water_mark(orders(spark, d), state)
    return state, op.monthly_orders(op.completed(fresh, "order_status"))


def _state_and_staged_batch(spark, d):
    """For a batch that is joined with itself: each use would read the orders once more."""
    state, batch = _state_and_batch(spark, d)
    return state, src.stage(batch, src.scratch_dir(spark))


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_sales(spark, d):
    return sales(spark, d)


@query
def scan_orders(spark, d):
    return orders(spark, d)


@query
def namespaced_table(spark, d):
    """From a source to a target, each found by its name in a namespace; the target's is the default."""
    sales(spark, d).createOrReplaceGlobalTempView("sales")
    source = src.read_sales(spark, src.table_name("global_temp", "sales"))
    location = src.table_name("sales_by_status")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS public LOCATION '{src.scratch_dir(spark)}'")
    spark.sql(f"DROP TABLE IF EXISTS {location}")
    op.append(source, src.Target(location, schemas.SALES, ("order_id",), "status"))
    return src.read_sales(spark, location)


@query
def read_target_state(spark, d):
    return src.read_state(spark, _whole_kpi(spark, d))


@query
def stage_roundtrip(spark, d):
    return src.stage(_done_sales(spark, d), src.scratch_dir(spark))


@query
def append_sink(spark, d):
    target = src.daily_target(src.scratch_dir(spark))
    stats = daily_table(sales(spark, d), drop_repeats=False)
    op.append(stats, target)
    op.append(stats, target)
    return src.read_state(spark, target)


@query
def upsert_daily(spark, d):
    """Totals of all sales, then those of the finished ones put over them."""
    target = src.daily_target(src.scratch_dir(spark))
    label = F.date_add(fn.to_day("created_at"), 1).alias("date")
    op.append(op.daily_stats(sales(spark, d), label), target)
    op.upsert(daily_table(sales(spark, d)), target)
    return src.read_state(spark, target)


@query
def materialize_full(spark, d):
    """The second write replaces the first, which held the earlier orders only."""
    target = src.kpi_target(src.scratch_dir(spark), lookback="active")
    op.materialize(customer_kpi(_before_split(spark, d)), target)
    op.materialize(customer_kpi(orders(spark, d)), target)
    return src.read_state(spark, target)


@query
def materialize_incremental(spark, d):
    target = _stored_kpi(spark, d)
    since = op.high_water_mark(src.read_state(spark, target))
    fresh = refreshed_kpi(orders(spark, d), src.read_state(spark, target))
    recent = F.col("order_month") >= F.lit(since)
    op.upsert(fresh, target, touching=recent, unique=True)
    return src.read_state(spark, target)


@query
def first_run_branch(spark, d):
    all_orders = orders(spark, d)
    parts = []
    for target in (src.kpi_target(src.scratch_dir(spark)), _stored_kpi(spark, d)):
        incremental = src.exists(spark, target)
        rows = all_orders
        if incremental:
            rows = op.since_high_water_mark(rows, src.read_state(spark, target))
        parts.append(rows.withColumn("incremental", F.lit(incremental)))
    return parts[0].unionByName(parts[1])


# --- projections, filters, predicates --------------------------------------------------


@query
def project_columns(spark, d):
    return orders(spark, d).select("customer_id", "order_date", "order_amount")


@query
def filter_day_equality(spark, d):
    return op.on_day(sales(spark, d), "created_at", RUN_DATE - ONE_DAY)


@query
def filter_half_open_range(spark, d):
    return op.in_range(sales(spark, d), "created_at", RUN_DATE - ONE_DAY, RUN_DATE)


@query
def filter_completed(spark, d):
    return _done_sales(spark, d)


@query
def distinct_rows(spark, d):
    return op.dedupe(sales(spark, d))


@query
def filter_bound_params(spark, d):
    return op.sales_between(sales(spark, d), BACKFILL_START, RUN_DATE, op.COMPLETED)


@query
def rename_columns(spark, d):
    return op.daily_stats(sales(spark, d)).select("daily_total", "daily_orders")


@query
def constant_date_column(spark, d):
    return op.with_run_date(op.daily_stats(sales(spark, d)), RUN_DATE)


@query
def filter_high_water_mark(spark, d):
    state = src.read_state(spark, _stored_kpi(spark, d))
    return op.since_high_water_mark(orders(spark, d), state)


@query
def empty_input_guard(spark, d):
    return op.guard_nonempty(_done_sales(spark, d), on_empty="raise")


@query
def tautology_predicate(spark, d):
    unfiltered = op.where_all(sales(spark, d))
    return op.where_all(unfiltered, F.col("status") == op.COMPLETED)


# --- joins -----------------------------------------------------------------------------


def _segments(monthly):
    return monthly.select(
        *KEYS,
        fn.revenue_segment("monthly_revenue").alias("revenue_segment"),
        fn.frequency_segment("monthly_orders").alias("frequency_segment"),
        fn.aov_segment("avg_order_value").alias("aov_segment"),
    )


def _retention(monthly):
    previous = monthly.withColumn("prev_order_month", op.lag_metric("order_month"))
    status = fn.retention("order_month", "prev_order_month")
    return previous.select(*KEYS, status.alias("retention_status"))


def kpi_by_joins(monthly):
    """The full model with segments and retention joined to it instead of computed in place."""
    labels = ("revenue_segment", "frequency_segment", "aov_segment", "retention_status")
    growth = kpi_columns(op.previous_active(monthly), "active").drop(*labels)
    with_segments = op.left_join(growth, _segments(monthly), KEYS)
    return op.left_join(with_segments, _retention(monthly), KEYS)


@query
def join_segments(spark, d):
    monthly = _monthly(spark, d)
    return op.left_join(monthly, _segments(monthly), KEYS)


@query
def join_retention(spark, d):
    monthly = _monthly(spark, d)
    return op.left_join(monthly, _retention(monthly), KEYS)


@query
def kpi_joined(spark, d):
    return kpi_by_joins(_monthly(spark, d))


PREV_MONTH = {
    "monthly_orders": "prev_month_orders",
    "monthly_revenue": "prev_month_revenue",
    "avg_order_value": "prev_avg_order_value",
}
PREV_YEAR = {"monthly_orders": "prev_year_orders"}


@query
def join_state_prev_month(spark, d):
    state, batch = _state_and_batch(spark, d)
    return op.lookup(batch, state, 1, PREV_MONTH)


@query
def join_batch_prev_month(spark, d):
    _, batch = _state_and_staged_batch(spark, d)
    return op.lookup(batch, batch, 1, PREV_MONTH)


@query
def join_state_prev_year(spark, d):
    state, batch = _state_and_batch(spark, d)
    return op.lookup(batch, state, 12, PREV_YEAR)


@query
def join_batch_prev_year(spark, d):
    _, batch = _state_and_staged_batch(spark, d)
    return op.lookup(batch, batch, 12, PREV_YEAR)


@query
def join_last_month(spark, d):
    state, batch = _state_and_batch(spark, d)
    last = op.last_month(state).withColumnRenamed("order_month", "last_month")
    return op.left_join(batch, last, "customer_id")


# --- aggregations ----------------------------------------------------------------------


@query
def daily_customer_stats(spark, d):
    return op.daily_stats(_done_sales(spark, d))


@query
def monthly_customer_orders(spark, d):
    return _monthly(spark, d)


@query
def count_distinct_orders(spark, d):
    return _monthly(spark, d).select(*KEYS, "monthly_orders")


@query
def sum_revenue(spark, d):
    return _monthly(spark, d).select(*KEYS, "monthly_revenue")


@query
def avg_order_value(spark, d):
    return _monthly(spark, d).select(*KEYS, "avg_order_value")


@query
def global_max_month(spark, d):
    return op.max_month(src.read_state(spark, _whole_kpi(spark, d)))


@query
def customer_last_month(spark, d):
    return op.last_month(src.read_state(spark, _whole_kpi(spark, d)))


@query
def row_count_metrics(spark, d):
    rows, extracted = op.with_row_metrics(_done_sales(spark, d), "extracted")
    stats, transformed = op.with_row_metrics(op.daily_stats(rows), "transformed")
    stats.write.format("noop").mode("overwrite").save()
    counts = [("extracted", extracted.get["rows"]), ("transformed", transformed.get["rows"])]
    return spark.createDataFrame(counts, "step string, row_count bigint")


# --- windows ---------------------------------------------------------------------------


def _lag_query(name, column, n=1):
    def run(spark, d):
        return _monthly(spark, d).select(*KEYS, op.lag_metric(column, n).alias(name))

    return run


for _key, _name, _column, _n in (
    ("lag_prev_orders", "prev_month_orders", "monthly_orders", 1),
    ("lag_prev_revenue", "prev_month_revenue", "monthly_revenue", 1),
    ("lag_prev_aov", "prev_avg_order_value", "avg_order_value", 1),
    ("lag_prev_year_orders", "prev_year_orders", "monthly_orders", 12),
    ("lag_prev_order_month", "prev_order_month", "order_month", 1),
):
    _run = _lag_query(_name, _column, _n)
    _run.__name__ = _key
    query(_run)


# --- derived expressions ---------------------------------------------------------------


def _kpi_query(column, lookback="active"):
    def run(spark, d):
        return customer_kpi(orders(spark, d), lookback).select(*KEYS, column)

    return run


for _key, _column in (
    ("orders_mom_growth", "orders_mom_growth_pct"),
    ("revenue_mom_growth", "revenue_mom_growth_pct"),
    ("aov_mom_growth", "aov_mom_growth_pct"),
    ("orders_yoy_growth", "orders_yoy_growth_pct"),
    ("revenue_segment", "revenue_segment"),
    ("frequency_segment", "frequency_segment"),
    ("aov_segment", "aov_segment"),
    ("retention_status", "retention_status"),
):
    _run = _kpi_query(_column)
    _run.__name__ = _key
    query(_run)


@query
def coalesce_prev_values(spark, d):
    """Previous values from the batch where it has the month, otherwise from the state."""
    state, batch = _state_and_staged_batch(spark, d)
    month = {"order_month": "m", **PREV_MONTH}
    df = batch.select(*KEYS)
    for side, prefix in ((batch, "b_"), (state, "s_")):
        df = op.lookup(df, side, 1, {k: prefix + v for k, v in month.items()})
        df = op.lookup(df, side, 12, {k: prefix + v for k, v in PREV_YEAR.items()})
    before = state.where(F.col("order_month") < F.lit(op.high_water_mark(state)))
    df = op.left_join(df, op.last_month(before).withColumnRenamed("order_month", "l"), "customer_id")
    values = [*PREV_MONTH.values(), *PREV_YEAR.values()]
    return df.select(
        *KEYS,
        fn.first_known("b_m", "s_m", "l").alias("prev_order_month"),
        *[fn.first_known("b_" + v, "s_" + v).alias(v) for v in values],
    )


# --- scalar functions ------------------------------------------------------------------


def _over_orders(spark, d, **columns):
    return orders(spark, d).select("order_id", *[c.alias(n) for n, c in columns.items()])


def _over_previous(spark, d, **columns):
    previous = op.previous_active(_monthly(spark, d))
    return previous.select(*KEYS, *[c.alias(n) for n, c in columns.items()])


@query
def fn_date_trunc_month(spark, d):
    return _over_orders(spark, d, order_month=fn.month_start("order_date"))


@query
def fn_date_part_month(spark, d):
    return _over_orders(spark, d, month=fn.month_number("order_date").cast("long"))


@query
def fn_to_date(spark, d):
    return _over_orders(spark, d, day=fn.to_day("order_date"))


@query
def fn_minus_month(spark, d):
    return _over_orders(spark, d, day=fn.minus_months(fn.to_day("order_date"), 1))


@query
def fn_minus_year(spark, d):
    return _over_orders(spark, d, day=fn.minus_months(fn.to_day("order_date"), 12))


@query
def fn_minus_day(spark, d):
    return _over_orders(spark, d, day=fn.minus_days(fn.to_day("order_date"), 1))


@query
def fn_format_date(spark, d):
    return _over_orders(spark, d, day=fn.iso_date("order_date"))


@query
def fn_round2(spark, d):
    return _over_orders(spark, d, amount=fn.round2("order_amount"))


@query
def fn_nullif(spark, d):
    return _over_orders(spark, d, customer=fn.null_if_zero("customer_id"))


@query
def fn_coalesce(spark, d):
    return _over_previous(spark, d, orders=fn.first_known("prev_year_orders", "monthly_orders"))


@query
def fn_case_when(spark, d):
    amount = F.col("order_amount")
    size = fn.case([(amount >= 2000, "large"), (amount >= 500, "medium")], "small")
    return _over_orders(spark, d, size=size)


@query
def fn_percent_arithmetic(spark, d):
    change = F.col("monthly_orders") - F.col("prev_month_orders")
    return _over_previous(spark, d, change_pct=fn.pct(change, "prev_month_orders"))


@query
def fn_is_null(spark, d):
    first = fn.is_null("prev_month_orders") | (F.col("prev_month_orders") == 0)
    return _over_previous(spark, d, nothing_before=first)


@query
def fn_concat_key(spark, d):
    return _monthly(spark, d).select(fn.concat_key(*KEYS).alias("row_key"), "monthly_orders")


# --- sorting ---------------------------------------------------------------------------


@query
def order_kpi(spark, d):
    return op.sort_kpi(_monthly(spark, d))


@query
def order_daily(spark, d):
    return op.sort_daily(op.daily_stats(_done_sales(spark, d)))


# --- complete jobs ---------------------------------------------------------------------


@query
def daily_job_v1(spark, d):
    target = src.daily_target(src.scratch_dir(spark))
    run_daily(spark, sales(spark, d), target, RUN_DATE, drop_repeats=False, write="append")
    return src.read_state(spark, target).select(*LAYOUT_AS_IS)


@query
def daily_job_v2(spark, d):
    """Run twice: the second run finds its keys stored and changes nothing."""
    target = src.daily_target(src.scratch_dir(spark))
    for _ in range(2):
        run_daily(spark, sales(spark, d), target, RUN_DATE, drop_repeats=True, write="upsert")
    return src.read_state(spark, target).select(*LAYOUT_DEDUPED)


@query
def daily_backfill(spark, d):
    """One run date first, then all the missed ones in one job."""
    target = src.daily_target(src.scratch_dir(spark))
    run_daily(spark, sales(spark, d), target, RUN_DATE)
    run_daily_backfill(
        spark, sales(spark, d), target, BACKFILL_START, BACKFILL_END, only_missed=True
    )
    return src.read_state(spark, target)


@query
def customer_kpi_full(spark, d):
    return customer_kpi(orders(spark, d), "active", ordered=True)


@query
def customer_kpi_calendar(spark, d):
    return customer_kpi(orders(spark, d), "calendar")


@query
def customer_kpi_incremental(spark, d):
    """Built from the orders before the split, then refreshed with all orders."""
    target = _stored_kpi(spark, d)
    run_customer_kpi(spark, orders(spark, d), target)
    return src.read_state(spark, target)


@query
def kpi_calendar_retention(spark, d):
    """Retained by the calendar: built before the split, refreshed with all orders."""
    target = src.kpi_target(src.scratch_dir(spark), retention_rule="calendar")
    for day in (SPLIT.date(), dt.date(2100, 1, 1)):
        run_customer_kpi(spark, before(orders(spark, d), day), target)
    return src.read_state(spark, target).select(*KEYS, "retention_status")


# --- kept state ------------------------------------------------------------------------


@query
def kpi_refresh_kept_activity(spark, d):
    """Three refreshes over a kept table of each customer's last active month."""
    target = src.kpi_target(src.scratch_dir(spark))
    kept = src.last_active_target(src.scratch_dir(spark))
    for day in (FIRST_SPLIT, SPLIT.date(), SPLIT.date()):
        run_customer_kpi(spark, before(orders(spark, d), day), target, last_active=kept)
    run_customer_kpi(spark, orders(spark, d), target, last_active=kept)
    return src.read_state(spark, target)


@query
def last_active_months(spark, d):
    """What is kept for a refresh that begins at the split: the last months before its window."""
    kept = src.last_active_target(src.scratch_dir(spark))
    state = customer_kpi(orders(spark, d), "calendar")
    last_active_before(spark, state, kept, FIRST_SPLIT.replace(day=1))
    return last_active_before(spark, state, kept, SPLIT.date().replace(day=1))


@query
def source_month_digests(spark, d):
    """Finished orders of each source month, as the digests count them."""
    return month_digests(orders(spark, d)).select("order_month", "n_rows")


@query
def kpi_refresh_late_orders(spark, d):
    """Built without some orders of all months, then refreshed with them by the digests."""
    target = src.kpi_target(src.scratch_dir(spark))
    digests = src.digests_target(src.scratch_dir(spark))
    everything = orders(spark, d)
    late = F.col("order_id") % 7 == 0
    early = before(everything, SPLIT.date()).where(~late)
    run_customer_kpi(spark, early, target, digests=digests)
    run_customer_kpi(spark, everything, target, digests=digests)
    return src.read_state(spark, target)


def _in_catalog(spark, d, target):
    """The orders' KPI rows in a catalog table of the target's kind, which the caller drops."""
    op.materialize(customer_kpi(before(orders(spark, d), SPLIT.date()), "calendar"), target)


def _dropped(spark, target, rows):
    """The rows of a catalog table that goes with the query."""
    out = src.stage(rows, src.scratch_dir(spark))
    op.drop_target(spark, target)
    return out


@query
def rebuild_by_switch(spark, d):
    """A catalog table built before the split, and switched to a rebuild of all orders."""
    target = src.kpi_target(f"rebuilt_{uuid.uuid4().hex}")
    _in_catalog(spark, d, target)
    op.materialize(customer_kpi(orders(spark, d), "calendar"), target)
    return _dropped(spark, target, src.read_state(spark, target))


@query
def upsert_in_buckets(spark, d):
    """A table bucketed by customer, refreshed where its rows lie."""
    target = src.kpi_target(f"bucketed_{uuid.uuid4().hex}", buckets=8)
    _in_catalog(spark, d, target)
    run_customer_kpi(spark, orders(spark, d), target)
    return _dropped(spark, target, src.read_state(spark, target))


@query
def customer_point_read(spark, d):
    """One customer's rows of a bucketed table: one bucket of each month is read."""
    target = src.kpi_target(f"bucketed_{uuid.uuid4().hex}", buckets=8)
    op.materialize(customer_kpi(orders(spark, d), "calendar"), target)
    return _dropped(spark, target, src.read_state(spark, target).where("customer_id = 7"))


@query
def backfill_with_ledger(spark, d):
    """Backfills that note their run dates; the second finds only the new end missed."""
    target = src.daily_target(src.scratch_dir(spark))
    ledger = src.ledger_target(src.scratch_dir(spark))
    for end in (RUN_DATE, BACKFILL_END):
        run_daily_backfill(
            spark, sales(spark, d), target, BACKFILL_START, end, only_missed=True, ledger=ledger
        )
    return src.read_state(spark, target)


@query
def noted_days(spark, d):
    """Each run date of a backfill, and whether it has rows."""
    target = src.daily_target(src.scratch_dir(spark))
    ledger = src.ledger_target(src.scratch_dir(spark))
    run_daily_backfill(
        spark, sales(spark, d), target, BACKFILL_START, BACKFILL_END, ledger=ledger
    )
    return src.read_state(spark, ledger).select("date", "has_rows")
