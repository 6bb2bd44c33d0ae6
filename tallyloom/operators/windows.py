"""Values of a customer's earlier months.

The input has one row per customer and month, so a window partition holds at most as many
rows as there are months, also for a customer with very many orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import month_index


def known_key() -> Column:
    """Whether a join on customer and month could match the row."""
    return F.col("customer_id").isNotNull() & F.col("order_month").isNotNull()


def _by_month(index: Column | None) -> WindowSpec:
    index = month_index("order_month") if index is None else index
    return Window.partitionBy("customer_id").orderBy(index)


def lag_metric(c: str, n: int = 1) -> Column:
    """Value ``n`` rows back, that is ``n`` active months; a null month sorts last."""
    rows = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("order_month"))
    return F.lag(c, n).over(rows)


def months_back(c: str, n: int, index: Column | None = None) -> Column:
    """Value exactly ``n`` calendar months back, null if that month is absent.

    Equal to a left self-join on (customer, month - n), without the join. Null keys match
    nothing, as in a join. ``index`` is the month index where the input already has it; rows
    sorted by that column are not sorted again.
    """
    return F.when(known_key(), F.first(c).over(_by_month(index).rangeBetween(-n, -n)))


def previous_active(monthly: DataFrame) -> DataFrame:
    """Previous values by active month: one row back, and twelve rows back for the year."""
    return monthly.withColumns(
        {
            "prev_month_orders": lag_metric("monthly_orders"),
            "prev_month_revenue": lag_metric("monthly_revenue"),
            "prev_avg_order_value": lag_metric("avg_order_value"),
            "prev_year_orders": lag_metric("monthly_orders", 12),
            "prev_order_month": lag_metric("order_month"),
        }
    )


def previous_calendar(monthly: DataFrame, index: Column | None = None) -> DataFrame:
    """Previous values by calendar month and year, and the last active month before."""
    last_active = F.lag("order_month").over(_by_month(index))
    return monthly.withColumns(
        {
            "prev_month_orders": months_back("monthly_orders", 1, index),
            "prev_month_revenue": months_back("monthly_revenue", 1, index),
            "prev_avg_order_value": months_back("avg_order_value", 1, index),
            "prev_year_orders": months_back("monthly_orders", 12, index),
            "prev_order_month": F.when(known_key(), last_active),
        }
    )
