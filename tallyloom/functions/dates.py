"""Calendar expressions over dates and zone-less timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(c: Column | str) -> Column:
    return F.to_date(c)


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(c, "month")


def month_number(c: Column | str) -> Column:
    """1 to 12."""
    return F.month(c)


def month_index(c: Column | str) -> Column:
    """Months counted without a break, so that a range frame can step over them."""
    return F.year(c) * 12 + F.month(c)


def minus_months(c: Column | str, n: int) -> Column:
    return F.add_months(c, -n)


def minus_days(c: Column | str, n: int) -> Column:
    return F.date_sub(c, n)


def iso_date(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def at_midnight(day: dt.date) -> Column:
    """Literal to compare with a timestamp_ntz column.

    ``F.lit(datetime)`` would be a zoned timestamp and put a cast around the column, which
    keeps the predicate out of the Parquet scan.
    """
    return F.lit(day).cast("timestamp_ntz")
