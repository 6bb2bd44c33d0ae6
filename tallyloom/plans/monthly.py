"""Monthly customer KPI as a full rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    aov_segment,
    frequency_segment,
    growth_pct,
    retention,
    revenue_segment,
)
from ..operators import (
    completed,
    monthly_orders,
    previous_active,
    previous_calendar,
    sort_kpi,
)
from ..operators.windows import known_key

# Decimals up to here, doubles in the result.
MONEY_COLUMNS = ("monthly_revenue", "prev_month_revenue")


def kpi_columns(
    monthly: DataFrame, lookback: str, retention_rule: str = "numbers"
) -> DataFrame:
    """KPI rows from customer-months that carry their previous values."""
    labels = {
        "revenue_segment": revenue_segment("monthly_revenue"),
        "frequency_segment": frequency_segment("monthly_orders"),
        "aov_segment": aov_segment("avg_order_value"),
        "retention_status": retention("order_month", "prev_order_month", retention_rule),
    }
    if lookback == "active":
        # Here the labels belong to the row by its key, and a null key matches nothing.
        labels = {name: F.when(known_key(), label) for name, label in labels.items()}
    derived = monthly.withColumns(
        {
            "orders_mom_growth_pct": growth_pct("monthly_orders", "prev_month_orders"),
            "revenue_mom_growth_pct": growth_pct("monthly_revenue", "prev_month_revenue"),
            "aov_mom_growth_pct": growth_pct("avg_order_value", "prev_avg_order_value"),
            "orders_yoy_growth_pct": growth_pct("monthly_orders", "prev_year_orders"),
            **labels,
        }
    )
    schema = schemas.KPI_ACTIVE if lookback == "active" else schemas.KPI_CALENDAR
    return derived.select(
        *[F.col(n).cast("double").alias(n) if n in MONEY_COLUMNS else n for n in schema.names]
    )


def customer_kpi(
    orders: DataFrame,
    lookback: str = "active",
    unique_order_id: bool = False,
    ordered: bool = False,
    retention_rule: str = "numbers",
) -> DataFrame:
    """KPI rows of every customer-month.

    ``lookback="active"`` compares with the customer's previous active months,
    ``"calendar"`` with the previous calendar month and the same month of last year.
    One scan, no join; the growth, segments and retention all come from one window over the
    aggregated months.

    ``ordered`` sorts the rows by customer and month, nulls last. The customer-months are then
    put into ranges of customers before the window, and that one shuffle serves the sort too.
    """
    if lookback not in ("active", "calendar"):
        raise ValueError(f"lookback must be 'active' or 'calendar', not {lookback!r}")
    monthly = monthly_orders(completed(orders, "order_status"), unique_order_id)
    previous = previous_active if lookback == "active" else previous_calendar
    if not ordered:
        return kpi_columns(previous(monthly), lookback, retention_rule)
    in_ranges = monthly.repartitionByRange(F.asc_nulls_last("customer_id"))
    return sort_kpi(kpi_columns(previous(in_ranges), lookback, retention_rule))
