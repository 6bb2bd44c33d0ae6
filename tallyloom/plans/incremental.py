"""Monthly customer KPI as an incremental refresh, with calendar lookbacks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import at_midnight, minus_months, month_index
from ..operators import (
    completed,
    high_water_mark,
    last_month,
    materialize,
    monthly_orders,
    previous_calendar,
    upsert,
)
from ..sources import (
    Target,
    find_state,
    read_orders,
    require_same_table,
    scratch_dir,
    stage,
    stored_parts,
)
from ..sources.readers import remove
from .last_active import forget_last_active, last_active_before
from .late_orders import (
    collect_digests,
    late_months,
    months_later,
    note_digests,
    noted_digests,
    refresh_with_late_months,
)
from .monthly import customer_kpi, kpi_columns

METRICS = ("monthly_orders", "monthly_revenue", "avg_order_value")


def _history(
    state: DataFrame, since: dt.date, like: DataFrame, older: DataFrame | None = None
) -> DataFrame:
    """Stored customer-months that a month from ``since`` on can look back to.

    Metrics are needed for a year only. Of older months just each customer's last one
    counts, as a possible previous active month. It is given as ``older``, or that part reads the key
    columns of all older months.
    """
    year_before = minus_months(F.lit(since), 12)
    recent = state.where(F.col("order_month") >= year_before)
    if older is None:
        older = last_month(state.where(F.col("order_month") < year_before))
    # Revenue is stored as a double; as the decimal it came from, differences are exact again.
    revenue = F.col("monthly_revenue").cast(like.schema["monthly_revenue"].dataType)
    recent = recent.select("customer_id", "order_month", *METRICS)
    return recent.withColumn("monthly_revenue", revenue).unionByName(
        older, allowMissingColumns=True
    )


def _batch_over_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Both sets of customer-months, a stored one only where the batch has none.

    A month that is computed anew must be compared with by its new values, so the batch row
    sorts first and the row after it with the same month is dropped. Customers without any
    batch row go too. This partitions and sorts by what the lookups need next: no join and
    no further shuffle.
    """
    both = batch.withColumn("_stored", F.lit(0)).unionByName(
        stored.withColumn("_stored", F.lit(1))
    )
    both = both.withColumn("_index", month_index("order_month"))
    rows = Window.partitionBy("customer_id").orderBy("_index", "_stored")
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = both.withColumns(
        {
            "_repeated": F.col("_index").eqNullSafe(F.lag("_index").over(rows)),
            "_absent": F.min("_stored").over(whole) == 1,
        }
    )
    return marked.where(~F.col("_repeated") & ~F.col("_absent")).drop("_repeated", "_absent")


def _recent_months(orders: DataFrame, since: dt.date, unique_order_id: bool) -> DataFrame:
    recent = completed(orders.where(F.col("order_date") >= at_midnight(since)), "order_status")
    return monthly_orders(recent, unique_order_id)


def _refreshed(
    batch: DataFrame,
    state: DataFrame,
    since: dt.date,
    older: DataFrame | None = None,
    retention_rule: str = "numbers",
) -> DataFrame:
    months = _batch_over_stored(batch, _history(state, since, batch, older))
    compared = previous_calendar(months, index=F.col("_index"))
    return kpi_columns(compared.where(F.col("_stored") == 0), "calendar", retention_rule)


def customer_kpi_incremental(
    orders: DataFrame, state: DataFrame, lookback_months: int = 0, unique_order_id: bool = False
) -> DataFrame:
    """KPI rows of the state's latest month and later; all rows when the state is empty.

    Equal to the same months of a full rebuild, given that no order of an earlier month was
    added or changed. ``lookback_months`` widens the months that are computed anew.
    """
    since = high_water_mark(state, lookback_months)
    if since is None:
        return customer_kpi(orders, "calendar", unique_order_id)
    return _refreshed(_recent_months(orders, since, unique_order_id), state, since)


def _stored_mark(
    spark: SparkSession, target: Target, state: DataFrame, lookback_months: int
) -> dt.date | None:
    """The high-water mark from the names of the partitions: rows of the latest one confirm it."""
    for month in stored_parts(spark, target):
        rows = state.where(F.col("order_month") == F.lit(month))
        if not rows.isEmpty():
            return high_water_mark(rows, lookback_months)
    return None


def _refresh_by_kept_activity(
    spark: SparkSession,
    orders: DataFrame,
    target: Target,
    state: DataFrame,
    since: dt.date,
    unique_order_id: bool,
    last_active: Target,
) -> None:
    """A refresh that opens thirteen months, and of the kept rows those of the batch's customers."""
    older = last_active_before(spark, state, last_active, months_later(since, -12))
    path = scratch_dir(spark)
    try:
        # Staged, as two uses of the batch would compute it twice.
        batch = stage(_recent_months(orders, since, unique_order_id), path)
        named = batch.select(F.col("customer_id").alias("_customer")).distinct()
        same = F.col("customer_id").eqNullSafe(F.col("_customer"))
        asked = older.join(named, same, "left_semi")
        recent = F.col("order_month") >= F.lit(since)
        rows = _refreshed(batch, state, since, asked, target.retention_rule)
        upsert(rows, target, touching=recent, unique=True, stored=state)
    finally:
        remove(spark, path)


def run_customer_kpi(
    spark: SparkSession,
    src: DataFrame | str,
    target: Target,
    lookback_months: int = 0,
    unique_order_id: bool = False,
    last_active: Target | None = None,
    digests: Target | None = None,
) -> dt.date | None:
    """Build the target on the first run, refresh it afterwards.

    A target with the active lookback is built in full each time: its values depend on all
    earlier months. A stored table with the other lookback is refused. Returns the first
    month computed anew, None for a full build.

    ``last_active`` names a table in which each customer's last active month is kept, so that the cost of
    a refresh does not grow with the history. ``digests`` names a table of source months' digests: it
    finds orders that were added to, changed in or removed from any older month, at the cost of a scan of the
    source, and rewrites the months that depend on them. A first run with digests notes them only.
    Both serve one target each, which nothing but this function should write.
    """
    orders = read_orders(spark, src)
    require_same_table(spark, target)
    if target.lookback == "active":
        if last_active is not None or digests is not None:
            raise ValueError("a target with the active lookback is built in full each time")
        rows = customer_kpi(
            orders, "active", unique_order_id, retention_rule=target.retention_rule
        )
        materialize(rows, target)
        return None
    # Digests are taken first: what comes later is found by the next run.
    now = None if digests is None else collect_digests(orders)
    state = find_state(spark, target)
    since = None if state is None else _stored_mark(spark, target, state, lookback_months)
    noted = {} if digests is None or since is None else noted_digests(spark, digests)
    late = late_months(now, noted, since) if noted else []
    if last_active is not None and (since is None or late):
        forget_last_active(spark, last_active)
    if since is None:
        rows = customer_kpi(
            orders, "calendar", unique_order_id, retention_rule=target.retention_rule
        )
        materialize(rows, target)
    elif late:
        refresh_with_late_months(spark, orders, target, state, since, late, unique_order_id)
    elif last_active is not None:
        _refresh_by_kept_activity(
            spark, orders, target, state, since, unique_order_id, last_active
        )
    else:
        batch = _recent_months(orders, since, unique_order_id)
        rows = _refreshed(batch, state, since, retention_rule=target.retention_rule)
        recent = F.col("order_month") >= F.lit(since)
        upsert(rows, target, touching=recent, unique=True, stored=state)
    if digests is not None:
        note_digests(spark, now, digests)
    return since
