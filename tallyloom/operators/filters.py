"""Row filters and guards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import at_midnight, to_day
from .aggregates import high_water_mark

# Fixed value: the status of a finished sale or order.
COMPLETED = "completed"


class EmptyInput(ValueError):
    """A step that needs rows got none."""


def completed(df: DataFrame, status: str) -> DataFrame:
    """Rows in the finished status; a null status is dropped."""
    return df.where(F.col(status) == COMPLETED)


def on_day(df: DataFrame, ts: str, day: dt.date) -> DataFrame:
    """Rows whose timestamp falls on the day."""
    return df.where(to_day(ts) == F.lit(day))


def in_range(df: DataFrame, ts: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Rows with lo <= timestamp < hi, in the form the Parquet scan can prune by."""
    return df.where((F.col(ts) >= at_midnight(lo)) & (F.col(ts) < at_midnight(hi)))


def where_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition; all rows when there is none."""
    predicate = F.lit(True)
    for condition in conditions:
        predicate = predicate & condition
    return df.where(predicate)


def sales_between(sales: DataFrame, lo: dt.date, hi: dt.date, status: str) -> DataFrame:
    """The extraction statement with bound values: no value becomes part of the text."""
    return sales.sparkSession.sql(
        """
        SELECT * FROM {sales}
        WHERE created_at >= CAST(:lo AS TIMESTAMP_NTZ)
          AND created_at < CAST(:hi AS TIMESTAMP_NTZ)
          AND status = :status
        """,
        args={"lo": lo, "hi": hi, "status": status},
        sales=sales,
    )


def dedupe(rows: DataFrame) -> DataFrame:
    """Drop rows that repeat another in every column.

    The shuffle is keyed by all columns and the copies of a row collapse on the map side, so
    neither a hot customer nor a row with very many copies lands in one task.
    """
    return rows.distinct()


def with_run_date(df: DataFrame, run_date: dt.date) -> DataFrame:
    return df.withColumn("date", F.lit(run_date))


def since_high_water_mark(
    orders: DataFrame, state: DataFrame, lookback_months: int = 0
) -> DataFrame:
    """Orders of the state's latest month and later; all orders when the state is empty.

    The mark is a month start, so ``month(order_date) >= mark`` is ``order_date >= mark``.
    That form, with the one value collected, reaches the scan; a truncated column or a
    scalar subquery does not.
    """
    mark = high_water_mark(state, lookback_months)
    return orders if mark is None else orders.where(F.col("order_date") >= at_midnight(mark))


def guard_nonempty(df: DataFrame, on_empty: str = "skip") -> DataFrame | None:
    """The frame itself if it has a row; otherwise None ("skip") or EmptyInput ("raise").

    Call it on a filtered scan, before any aggregation: it then stops at the first row.
    """
    if on_empty not in ("skip", "raise"):
        raise ValueError(f"on_empty must be 'skip' or 'raise', not {on_empty!r}")
    if not df.isEmpty():
        return df
    if on_empty == "raise":
        raise EmptyInput("no rows in the input")
    return None


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the job at the first row that does not meet the condition; costs no extra pass."""
    failure = F.raise_error(F.lit(message)).cast("boolean")
    return df.where(F.when(condition, True).otherwise(failure))
