"""Daily totals per customer.

A run for date D takes the sales of the day before, D-1, and labels them D.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import at_midnight, to_day
from ..operators import (
    append,
    completed,
    daily_stats,
    dedupe,
    guard_nonempty,
    in_range,
    upsert,
    with_row_metrics,
    with_run_date,
)
from ..sources import Target, read_sales, read_state

ONE_DAY = dt.timedelta(days=1)
# Ranges of a scan's predicate at most; more are joined over the smallest gaps.
MOST_RANGES = 32

# Column order of a result, by whether repeated rows are dropped.
LAYOUT_AS_IS = ("customer_id", "date", "daily_total", "daily_orders")
LAYOUT_DEDUPED = ("customer_id", "daily_total", "daily_orders", "date")


def _finished(sales: DataFrame, drop_repeats: bool) -> DataFrame:
    rows = completed(sales, "status")
    # The status is the same in all rows by now; without it the distinct is over fixed-width
    # columns only.
    return dedupe(rows.drop("status")) if drop_repeats else rows


def _layout(stats: DataFrame, drop_repeats: bool) -> DataFrame:
    return stats.select(*(LAYOUT_DEDUPED if drop_repeats else LAYOUT_AS_IS))


def daily_table(sales: DataFrame, drop_repeats: bool = True) -> DataFrame:
    """Totals of every day in the sales, each labelled with the day after."""
    label = F.date_add(to_day("created_at"), 1).alias("date")
    return _layout(daily_stats(_finished(sales, drop_repeats), label), drop_repeats)


def _of_run_date(rows: DataFrame, run_date: dt.date, drop_repeats: bool) -> DataFrame:
    return _layout(with_run_date(daily_stats(rows), run_date), drop_repeats)


def _rows_of_run_date(sales: DataFrame, run_date: dt.date, drop_repeats: bool) -> DataFrame:
    return _finished(in_range(sales, "created_at", run_date - ONE_DAY, run_date), drop_repeats)


def daily_job(sales: DataFrame, run_date: dt.date, drop_repeats: bool = True) -> DataFrame:
    """Totals of one run date."""
    rows = _rows_of_run_date(sales, run_date, drop_repeats)
    return _of_run_date(rows, run_date, drop_repeats)


def daily_backfill(
    sales: DataFrame, start: dt.date, end: dt.date, drop_repeats: bool = True
) -> DataFrame:
    """Totals of the run dates start to end, both included, in one job.

    Equal to the union of the single runs: copies of a row share its timestamp, hence its day.
    """
    return daily_table(in_range(sales, "created_at", start - ONE_DAY, end), drop_repeats)


@dataclass(frozen=True)
class DailyRun:
    """A run that wrote something; with row counts where they were asked for."""

    run_date: dt.date
    extracted: int | None = None
    written: int | None = None


def run_daily(
    spark: SparkSession,
    src: DataFrame | str,
    target: Target,
    run_date: dt.date,
    drop_repeats: bool = True,
    write: str = "upsert",
    on_empty: str = "skip",
    count_rows: bool = False,
    ledger: Target | None = None,
) -> DailyRun | None:
    """Compute one run date and write it. None when there was nothing to write.

    ``ledger`` names a table in which computed run dates are noted, also those without rows.
    ``count_rows`` observes the rows extracted and the totals written, within the same job:
    with repeats dropped the finished rows that go into the totals, else all rows of the day,
    whatever their status. It interrupts generated code, so it is off unless asked for.
    """
    if write not in ("append", "upsert"):
        raise ValueError(f"write must be 'append' or 'upsert', not {write!r}")
    sales = read_sales(spark, src)
    # Sales without a customer are in no total, so a day of such sales has nothing to write.
    counted = _rows_of_run_date(sales, run_date, False).where(F.col("customer_id").isNotNull())
    if guard_nonempty(counted, on_empty) is None:
        _note(spark, ledger, {run_date: False})
        return None
    day = in_range(sales, "created_at", run_date - ONE_DAY, run_date)
    if count_rows and not drop_repeats:
        day, extracted = with_row_metrics(day, f"extracted {run_date}")
    rows = _finished(day, drop_repeats)
    if count_rows and drop_repeats:
        rows, extracted = with_row_metrics(rows, f"extracted {run_date}")
    stats = _of_run_date(rows, run_date, drop_repeats)
    if count_rows:
        stats, written = with_row_metrics(stats, f"written {run_date}")
    if write == "append":
        append(stats, target)
    else:
        upsert(stats, target, touching=F.col("date") == F.lit(run_date), unique=True)
    _note(spark, ledger, {run_date: True})
    if count_rows:
        return DailyRun(run_date, extracted.get["rows"], written.get["rows"])
    return DailyRun(run_date)


def _note(spark: SparkSession, ledger: Target | None, dates: dict[dt.date, bool]) -> None:
    """Note run dates, after their rows were written: a date that is lost in between is computed again."""
    if ledger is not None and dates:
        rows = [(d, has_rows, d.replace(day=1)) for d, has_rows in dates.items()]
        months = sorted({r[-1] for r in rows})
        noted = spark.createDataFrame(rows, ledger.schema)
        upsert(noted, ledger, touching=F.col("month").isin(months), unique=True)


def noted_run_dates(
    spark: SparkSession, ledger: Target, start: dt.date, end: dt.date
) -> dict[dt.date, bool]:
    """Run dates from start to end that were computed, and whether they have rows."""
    noted = read_state(spark, ledger).where(
        F.col("month").between(start.replace(day=1), end) & F.col("date").between(start, end)
    )
    return {r["date"]: r["has_rows"] for r in noted.collect()}  # one per day at most


def missed_run_dates(
    spark: SparkSession,
    target: Target,
    start: dt.date,
    end: dt.date,
    ledger: Target | None = None,
) -> list[dt.date]:
    """Run dates from start to end that the target holds no rows of and the ledger doesn't note."""
    stored = read_state(spark, target).where(F.col("date").between(start, end))
    done = {r[0] for r in stored.select("date").distinct().collect()}  # one per day at most
    if ledger is not None:
        done |= noted_run_dates(spark, ledger, start, end).keys()
    dates = [start + i * ONE_DAY for i in range((end - start).days + 1)]
    return [d for d in dates if d not in done]


def _among(column: str, days: list[dt.date]) -> Column:
    """Membership in a set of days, as one expression however many there are."""
    return F.expr(f"{column} IN ({', '.join(f"DATE '{d}'" for d in days)})")


def day_ranges(days: list[dt.date], most: int = MOST_RANGES) -> list[tuple[dt.date, dt.date]]:
    """Half-open ranges that cover the days (ascending), at most ``most``: the smallest gaps are covered too."""
    gaps = [(b - a).days for a, b in zip(days, days[1:])]
    widest = sorted(range(len(gaps)), key=lambda i: (-gaps[i], i))[: most - 1]
    cuts = sorted(i + 1 for i in widest if gaps[i] > 1)
    starts, ends = [0, *cuts], [*cuts, len(days)]
    return [(days[a], days[b - 1] + ONE_DAY) for a, b in zip(starts, ends)]


def _sales_of(sales: DataFrame, run_dates: list[dt.date]) -> DataFrame:
    """Sales of the run dates: ranges for the scan, and within them only the days asked for."""
    days = [d - ONE_DAY for d in run_dates]
    at = F.col("created_at")
    ranges = day_ranges(days)
    rows = sales.where(
        reduce(or_, [(at >= at_midnight(a)) & (at < at_midnight(b)) for a, b in ranges])
    )
    if sum((b - a).days for a, b in ranges) == len(days):
        return rows
    return rows.where(_among("CAST(created_at AS DATE)", days))


def run_daily_backfill(
    spark: SparkSession,
    src: DataFrame | str,
    target: Target,
    start: dt.date,
    end: dt.date,
    drop_repeats: bool = True,
    only_missed: bool = False,
    ledger: Target | None = None,
) -> list[dt.date]:
    """Write the run dates start to end in one job, or only those that were not computed.

    Without a ``ledger`` a day without sales counts as missed each time, for it stores no rows. With
    one it is noted, and later backfills neither read nor compute it. Returns the run dates computed.
    """
    sales = read_sales(spark, src)
    dates = [start + i * ONE_DAY for i in range((end - start).days + 1)]
    if only_missed:
        dates = missed_run_dates(spark, target, start, end, ledger)
        if not dates:
            return []
        stats = daily_table(_sales_of(sales, dates), drop_repeats)
        touching = _among("date", dates)
    else:
        stats = daily_backfill(sales, start, end, drop_repeats)
        touching = F.col("date").between(start, end)
    upsert(stats, target, touching=touching, unique=True)
    if ledger is not None:
        held = read_state(spark, target).where(touching).select("date").distinct().collect()
        with_rows = {r[0] for r in held}
        _note(spark, ledger, {d: d in with_rows for d in dates})
    return dates
