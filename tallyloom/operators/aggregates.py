"""Grouped aggregates and run metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import first_known, mean, month_start


def daily_stats(sales: DataFrame, *by: Column) -> DataFrame:
    """Total amount and number of sales per customer (and any further keys).

    Sales without a customer are left out, a customer whose amounts are all null has total
    0, and a sale counts when it has an order id, however often that id occurs.
    """
    return (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", *by)
        .agg(
            first_known(F.sum("amount").cast("double"), F.lit(0.0)).alias("daily_total"),
            F.count("order_id").alias("daily_orders"),
        )
    )


def monthly_orders(orders: DataFrame, unique_order_id: bool = False) -> DataFrame:
    """Distinct orders, revenue and mean order value per customer and month.

    Revenue and mean take every row, also of a repeated order id. The exact distinct count
    shuffles by (customer, month, order), which spreads a hot customer over all tasks. Pass
    ``unique_order_id=True`` only where the source guarantees one row per order: the count
    is then combined on the map side and that shuffle shrinks to one row per customer-month
    and task.
    """
    count = F.count("order_id") if unique_order_id else F.count_distinct("order_id")
    return orders.groupBy("customer_id", month_start("order_date").alias("order_month")).agg(
        count.alias("monthly_orders"),
        F.sum("order_amount").alias("monthly_revenue"),
        mean("order_amount").alias("avg_order_value"),
    )


def max_month(state: DataFrame) -> DataFrame:
    """One row: the latest stored month."""
    return state.agg(F.max("order_month").alias("order_month"))


def high_water_mark(state: DataFrame, lookback_months: int = 0) -> dt.date | None:
    """The latest stored month, moved back by ``lookback_months``; None for an empty state."""
    row = max_month(state).select(F.add_months("order_month", -lookback_months)).first()
    return row[0]


def last_month(state: DataFrame) -> DataFrame:
    """Each customer's latest stored month; reads the two key columns only."""
    return state.groupBy("customer_id").agg(F.max("order_month").alias("order_month"))


def with_row_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with its row count observed as ``rows`` while the job itself runs."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
