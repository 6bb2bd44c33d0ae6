"""Each customer's last active month before the window that a refresh opens, kept from one refresh to the next.

Without it a refresh reads the customers of all older months. The kept table has one row per
customer, in a partition named after the month before which it holds. A refresh whose window begins later takes
that partition, adds the months in between (their customers alone) and writes the next; the
former then goes. A partition appears as a whole or not at all, so a lost job leaves the former in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drop_partition, last_month, replace_partitions
from ..sources import Target, read_state, stored_parts

KEY = ("customer_id", "order_month")


def last_active_before(
    spark: SparkSession, state: DataFrame, kept: Target, before: dt.date
) -> DataFrame:
    """(customer_id, order_month): each customer's last stored month before ``before``; updates ``kept``.

    Where the kept rows hold for a later window only, as after a longer lookback, they stay as they
    are and the older months are read.
    """
    older = state.where(F.col("order_month") < F.lit(before)).select(*KEY)
    held = stored_parts(spark, kept)
    if held and held[0] > before:
        return last_month(older)
    if not held or held[0] < before:
        rows = last_month(older)
        if held:
            known = _of(read_state(spark, kept), held[0])
            since = older.where(F.col("order_month") >= F.lit(held[0]))
            rows = last_month(known.unionByName(since))
        replace_partitions(rows.withColumn("before", F.lit(before)), kept)
    for month in held:
        if month < before:
            drop_partition(spark, kept, str(month))
    return _of(read_state(spark, kept), before)


def _of(kept: DataFrame, before: dt.date) -> DataFrame:
    return kept.where(F.col("before") == F.lit(before)).select(*KEY)


def forget_last_active(spark: SparkSession, kept: Target) -> None:
    """Drop what is kept, after a change to months that it covers; the next refresh builds it anew."""
    for month in stored_parts(spark, kept):
        drop_partition(spark, kept, str(month))
