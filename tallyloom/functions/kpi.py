"""Customer segments and retention status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import month_index, month_number
from .values import bucket, case

# Lower bounds (inclusive) and labels of the segments.
REVENUE_SEGMENTS = ((10000, "VIP"), (5000, "Premium"), (1000, "Regular"))
REVENUE_REST = "Basic"
FREQUENCY_SEGMENTS = ((20, "Frequent"), (10, "Active"), (1, "Occasional"))
FREQUENCY_REST = "Inactive"
AOV_SEGMENTS = ((500, "High AOV"), (200, "Medium AOV"))
AOV_REST = "Low AOV"

# Retention labels.
RETAINED = "Retained"
NEW = "New"
REACTIVATED = "Reactivated"


def revenue_segment(revenue: Column | str) -> Column:
    return bucket(revenue, REVENUE_SEGMENTS, REVENUE_REST)


def frequency_segment(orders: Column | str) -> Column:
    return bucket(orders, FREQUENCY_SEGMENTS, FREQUENCY_REST)


def aov_segment(avg_order_value: Column | str) -> Column:
    return bucket(avg_order_value, AOV_SEGMENTS, AOV_REST)


def retention(
    month: Column | str, prev_month: Column | str, rule: str = "numbers"
) -> Column:
    """Status of a month, given the customer's previous active month.

    With ``rule="numbers"`` the month *numbers* are compared: December to January is not Retained,
    and January to February of a later year is. With ``rule="calendar"`` a month is Retained if the
    previous active one is the month before.
    """
    if rule not in ("numbers", "calendar"):
        raise ValueError(f"rule must be 'numbers' or 'calendar', not {rule!r}")
    number = month_number if rule == "numbers" else month_index
    prev = F.col(prev_month) if isinstance(prev_month, str) else prev_month
    return case(
        [(number(month) - number(prev) == 1, RETAINED), (prev.isNull(), NEW)],
        REACTIVATED,
    )
