"""Result order. A global sort costs a range shuffle: sort for a reader, not for storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_kpi(kpi: DataFrame) -> DataFrame:
    return kpi.orderBy(F.asc_nulls_last("customer_id"), F.asc_nulls_last("order_month"))


def sort_daily(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.asc_nulls_last("customer_id"))
