"""Left joins on customer and month. Both sides are unique in the key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    return left.join(right, [keys] if isinstance(keys, str) else list(keys), "left")


def lookup(
    batch: DataFrame, stored: DataFrame, months: int, columns: Mapping[str, str]
) -> DataFrame:
    """Columns (as ``{stored name: new name}``) of the same customer, ``months`` earlier.

    The stored month is moved forward rather than the batch month back, so a batch that is
    already partitioned by its key needs no further shuffle.
    """
    earlier = stored.select(
        F.col("customer_id").alias("_customer"),
        F.add_months("order_month", months).alias("_month"),
        *[F.col(name).alias(new) for name, new in columns.items()],
    )
    same = (F.col("customer_id") == F.col("_customer")) & (F.col("order_month") == F.col("_month"))
    return batch.join(earlier, same, "left").drop("_customer", "_month")
