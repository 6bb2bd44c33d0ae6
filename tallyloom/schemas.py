"""Input and output schemas. Every reader checks against these."""

from pyspark.sql import types as T

# Money is summed as an exact decimal, so a sum does not depend on row order or on task
# retries; it becomes a double only in the output columns.
MONEY = T.DecimalType(18, 2)

SALES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("amount", MONEY),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("order_amount", MONEY),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("order_status", T.StringType()),
    ]
)

DAILY_STATS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("daily_total", T.DoubleType()),
        T.StructField("daily_orders", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)

_KPI_FIELDS = (
    ("customer_id", T.LongType()),
    ("order_month", T.DateType()),
    ("monthly_orders", T.LongType()),
    ("monthly_revenue", T.DoubleType()),
    ("avg_order_value", T.DoubleType()),
    ("prev_month_orders", T.LongType()),
    ("prev_month_revenue", T.DoubleType()),
    ("prev_year_orders", T.LongType()),
    ("orders_mom_growth_pct", T.DoubleType()),
    ("revenue_mom_growth_pct", T.DoubleType()),
    ("aov_mom_growth_pct", T.DoubleType()),
    ("orders_yoy_growth_pct", T.DoubleType()),
    ("revenue_segment", T.StringType()),
    ("frequency_segment", T.StringType()),
    ("aov_segment", T.StringType()),
    ("retention_status", T.StringType()),
)

# The calendar model also reports the same month of last year.
KPI_CALENDAR = T.StructType([T.StructField(n, t) for n, t in _KPI_FIELDS])
KPI_ACTIVE = T.StructType(
    [T.StructField(n, t) for n, t in _KPI_FIELDS if n != "prev_year_orders"]
)

LAST_ACTIVE = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_month", T.DateType()),
        T.StructField("before", T.DateType()),
    ]
)

MONTH_DIGESTS = T.StructType(
    [
        T.StructField("order_month", T.DateType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("hash_sum", T.DecimalType(38, 0)),
        T.StructField("year", T.IntegerType()),
    ]
)

RUN_LEDGER = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("has_rows", T.BooleanType()),
        T.StructField("month", T.DateType()),
    ]
)
