"""The job inputs, bound to the shared test tables. Plain SQL that both engines accept."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..sources import read_orders, read_sales

# One customer has a third of all orders, eleven more have another third.
ORDERS_SQL = """
SELECT CASE WHEN o_custkey % 3 = 0 THEN 0
            WHEN o_custkey % 3 = 1 THEN 1 + o_custkey % 11
            ELSE o_custkey END AS customer_id,
       o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS order_amount,
       o_orderdate AS order_date,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'other' END AS order_status
FROM {orders}
"""

_SALES_ROWS = """
SELECT event_id AS order_id, user_id AS customer_id, event_id % 100 AS product_id,
       CAST(value AS DECIMAL(18,2)) AS amount,
       CASE WHEN event_type = 'purchase' THEN 'completed' ELSE event_type END AS status,
       ts AS created_at
FROM {events}
"""

# Every row comes twice, so dropping repeated rows shows.
SALES_SQL = _SALES_ROWS + "UNION ALL" + _SALES_ROWS

# Orders before this moment are the stored state of the incremental queries. It is not a
# month end, so the last stored month is partial and has to be computed anew.
SPLIT = dt.datetime(1998, 6, 15)

RUN_DATE = dt.date(2024, 1, 10)
BACKFILL_START = dt.date(2023, 10, 1)
BACKFILL_END = dt.date(2024, 12, 31)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return read_orders(spark, spark.sql(ORDERS_SQL, orders=table))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return read_sales(spark, spark.sql(SALES_SQL, events=table))
