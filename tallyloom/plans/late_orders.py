"""Orders that were added to, changed in or removed from months before the refreshed ones.

Beside the target lies a digest of each source month: the number of its finished orders and the sum of
their hashes. A month whose digest changed is late. It is computed anew, and so are the rows that look back
to it: those of the month after, of the same month a year later, and of the next active month of every customer
who became active or inactive in the late month. Only partitions of these months are rewritten.

A month that the source no longer has at all has left it, it was not changed: its stored rows stay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import at_midnight, month_index, month_start
from ..operators import completed, monthly_orders, previous_calendar, replace_partitions, upsert
from ..sources import Target, read_state, scratch_dir, stage
from ..sources.readers import remove
from .monthly import kpi_columns

KEY = ("customer_id", "order_month")
METRICS = ("monthly_orders", "monthly_revenue", "avg_order_value")


def months_later(month: dt.date, n: int) -> dt.date:
    index = 12 * month.year + month.month - 1 + n
    return dt.date(index // 12, index % 12 + 1, 1)


def month_digests(orders: DataFrame) -> DataFrame:
    """(order_month, n_rows, hash_sum) of the finished orders; orders without a date are left out.

    The sum of 64-bit hashes does not depend on the order of the rows and counts repeated ones. What is
    null goes into the hash beside the values, for a hash passes over nulls. Sums are taken before
    the shuffle: what reaches it is a row for each month and task.
    """
    values = ("customer_id", "order_id", "order_amount")
    hashed = F.xxhash64(*values, *[F.col(c).isNull() for c in values])
    dated = completed(orders, "order_status").where(F.col("order_date").isNotNull())
    return dated.groupBy(month_start("order_date").alias("order_month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(hashed.cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
    )


def collect_digests(orders: DataFrame) -> dict[dt.date, Row]:
    """The digest of each month; one row per month reaches the driver."""
    return {r.order_month: r for r in month_digests(orders).collect()}


def late_months(
    now: dict[dt.date, Row], noted: dict[dt.date, Row], since: dt.date
) -> list[dt.date]:
    """Months before ``since`` whose digest is not the one noted."""
    value = lambda r: None if r is None else (r.n_rows, r.hash_sum)
    return sorted(m for m, r in now.items() if m < since and value(r) != value(noted.get(m)))


def noted_digests(spark: SparkSession, digests: Target) -> dict[dt.date, Row]:
    return {r.order_month: r for r in read_state(spark, digests).collect()}


def note_digests(spark: SparkSession, now: dict[dt.date, Row], digests: Target) -> None:
    """Put the digests over the noted ones; months that the source no longer has keep theirs."""
    noted = noted_digests(spark, digests)
    new = [
        (m, r.n_rows, r.hash_sum, m.year)
        for m, r in now.items()
        if (old := noted.get(m)) is None or (old.n_rows, old.hash_sum) != (r.n_rows, r.hash_sum)
    ]
    if new:
        years = sorted({x[-1] for x in new})
        rows = spark.createDataFrame(new, digests.schema)
        upsert(rows, digests, touching=F.col("year").isin(years), unique=True)


def _within(column: str, months: Iterable[dt.date]) -> Column:
    """Whether a moment lies in one of the months, as ranges that reach the scan."""
    ranges: list[list[dt.date]] = []
    for m in sorted(months):
        if ranges and ranges[-1][1] == m:
            ranges[-1][1] = months_later(m, 1)
        else:
            ranges.append([m, months_later(m, 1)])
    c = F.col(column)
    return reduce(or_, [(c >= at_midnight(a)) & (c < at_midnight(b)) for a, b in ranges])


def _changed_customers(stored: DataFrame, fresh: DataFrame, late: Column) -> DataFrame:
    """(customer_id, order_month): who became active or inactive in a late month."""
    sides = [
        df.where(late).select(*KEY, F.lit(side).alias("side"))
        for side, df in enumerate((stored, fresh))
    ]
    # Each side has a key once, so a key that both have comes twice.
    both = sides[0].unionByName(sides[1]).groupBy(*KEY).agg(F.count("side").alias("n"))
    return both.where(F.col("n") == 1).select(*KEY)


def _next_active_months(changed: DataFrame, keys: DataFrame, upto: dt.date) -> list[dt.date]:
    """Months of the rows whose previous active month is another now; one per month at most."""
    later = keys.where(F.col("order_month") < F.lit(upto)).select(
        F.col("customer_id").alias("_customer"), F.col("order_month").alias("_month")
    )
    after = (F.col("customer_id") == F.col("_customer")) & (F.col("order_month") < F.col("_month"))
    follows = changed.join(later, after).groupBy(*KEY).agg(F.min("_month").alias("month"))
    return [r.month for r in follows.select("month").distinct().collect()]


def refresh_with_late_months(
    spark: SparkSession,
    orders: DataFrame,
    target: Target,
    state: DataFrame,
    since: dt.date,
    late: list[dt.date],
    unique_order_id: bool = False,
) -> list[dt.date]:
    """Rewrite the months from ``since`` on, the late ones, and those that look back to them.

    Equal to the same months of a full rebuild. Returns the months before ``since`` that were rewritten.
    Late and recent orders are scanned; of months that only look back, the stored metrics are taken.
    """
    month = F.col("order_month")
    is_late, is_recent = month.isin(late), month >= F.lit(since)
    chosen = _within("order_date", late) | (F.col("order_date") >= at_midnight(since))
    path = scratch_dir(spark)
    try:
        batch = monthly_orders(completed(orders.where(chosen), "order_status"), unique_order_id)
        fresh = stage(batch, path)
        old = state.where(month.isNotNull() & ~is_late & ~is_recent)
        keys = old.select(*KEY).unionByName(fresh.select(*KEY))
        follow = _next_active_months(_changed_customers(state, fresh, is_late), keys, since)
        rewritten = {*late, *follow, *(months_later(m, n) for m in late for n in (1, 12))}
        rewritten = sorted(m for m in rewritten if m < since)
        looked_at = {months_later(m, -n) for m in rewritten for n in (0, 1, 12)}
        with_metrics = month.isin(sorted(looked_at)) | (month >= F.lit(months_later(since, -12)))
        # Revenue is stored as a double; as the decimal it came from, differences are exact again.
        revenue = F.col("monthly_revenue").cast(fresh.schema["monthly_revenue"].dataType)
        measured = old.where(with_metrics).select(*KEY, *METRICS).withColumn("monthly_revenue", revenue)
        months = fresh.unionByName(measured).unionByName(
            old.where(~with_metrics).select(*KEY), allowMissingColumns=True
        )
        months = months.withColumn("_index", month_index("order_month"))
        compared = previous_calendar(months, index=F.col("_index"))
        chosen_rows = compared.where(month.isin(rewritten) | is_recent)
        rows = kpi_columns(chosen_rows, "calendar", target.retention_rule)
        replace_partitions(rows, target)
    finally:
        remove(spark, path)
    return rewritten
