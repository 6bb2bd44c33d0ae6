import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "segment, edges",
    [
        (
            fn.revenue_segment,
            {
                "999.99": "Basic",
                "1000": "Regular",
                "4999.99": "Regular",
                "5000": "Premium",
                "9999.99": "Premium",
                "10000": "VIP",
                None: "Basic",
            },
        ),
        (
            fn.frequency_segment,
            {
                "0": "Inactive",
                "1": "Occasional",
                "9": "Occasional",
                "10": "Active",
                "19": "Active",
                "20": "Frequent",
                None: "Inactive",
            },
        ),
        (
            fn.aov_segment,
            {
                "199.99": "Low AOV",
                "200": "Medium AOV",
                "499.99": "Medium AOV",
                "500": "High AOV",
                None: "Low AOV",
            },
        ),
    ],
)
def test_segment_edges(spark, segment, edges):
    df = spark.createDataFrame([(k,) for k in edges], "v string")
    amount = F.col("v").cast("decimal(18,2)")
    assert dict(df.select("v", segment(amount)).collect()) == edges


@pytest.mark.parametrize(
    "cur, prev, want",
    [
        (12, 10, 20.0),
        (1, 3, -66.67),
        (33, 32, 3.13),  # 3.125: half away from zero
        (31, 32, -3.13),
        (5, 0, None),
        (5, None, None),
        (None, 5, None),
        (0, 5, -100.0),
    ],
)
def test_growth(spark, cur, prev, want):
    df = spark.createDataFrame([(cur, prev)], "cur bigint, prev bigint")
    assert df.select(fn.growth_pct("cur", "prev")).first()[0] == want


def test_growth_of_decimals(spark):
    df = spark.createDataFrame(
        [(Decimal("100.30"), Decimal("100.20"))], "cur decimal(18,2), prev decimal(18,2)"
    )
    assert df.select(fn.growth_pct("cur", "prev")).first()[0] == 0.1


@pytest.mark.parametrize(
    "month, prev, want",
    [
        ("2024-02-01", "2024-01-01", "Retained"),
        ("2024-01-01", "2023-12-01", "Reactivated"),  # month numbers 1 and 12
        ("2024-02-01", "2023-01-01", "Retained"),  # month numbers 2 and 1
        ("2024-03-01", "2024-01-01", "Reactivated"),
        ("2024-03-01", None, "New"),
    ],
)
def test_retention(spark, month, prev, want):
    df = spark.createDataFrame([(month, prev)], "a string, b string")
    df = df.select(F.col("a").cast("date"), F.col("b").cast("date"))
    assert df.select(fn.retention("a", "b")).first()[0] == want


def test_dates(spark):
    at = F.lit("2024-03-31 23:59:59.999999").cast("timestamp_ntz")
    assert value(spark, fn.to_day(at)) == dt.date(2024, 3, 31)
    assert value(spark, fn.month_start(at)) == dt.date(2024, 3, 1)
    assert value(spark, fn.month_number(at)) == 3
    assert value(spark, fn.month_index(at)) == 2024 * 12 + 3
    assert value(spark, fn.minus_months(fn.to_day(at), 1)) == dt.date(2024, 2, 29)
    assert value(spark, fn.minus_months(fn.to_day(at), 12)) == dt.date(2023, 3, 31)
    assert value(spark, fn.minus_days(fn.to_day(at), 31)) == dt.date(2024, 2, 29)
    assert value(spark, fn.iso_date(at)) == "2024-03-31"
    assert value(spark, fn.at_midnight(dt.date(2024, 3, 31))) == dt.datetime(2024, 3, 31)


def test_values(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 5, 7)], "a bigint, b bigint, c bigint")
    got = df.select(
        fn.first_known("b", "a").alias("first"),
        fn.null_if_zero("c").alias("nz"),
        fn.is_null("b").alias("nil"),
        fn.concat_key("a", "c").alias("k"),
        fn.concat_key("a", "b").alias("k_null"),
        fn.pct("a", "c").alias("pct"),
        fn.case([(F.col("b") > 3, "big"), (F.col("a") == 1, "one")], "other").alias("case"),
    )
    assert rows(got, *got.columns) == [
        (1, None, True, "10", None, None, "one"),
        (5, 7, False, "27", "25", 2 * 100.0 / 7, "big"),
    ]


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "a decimal(18,2)")
    assert df.agg(fn.mean("a")).first()[0] is None


def test_retention_by_the_calendar(spark):
    months = [
        ("2024-01-01", "2023-12-01", "Retained"),
        ("2024-02-01", "2023-01-01", "Reactivated"),
        ("2024-02-01", "2024-01-01", "Retained"),
        ("2024-02-01", None, "New"),
    ]
    df = spark.createDataFrame(months, "m string, p string, want string")
    month, prev = F.col("m").cast("date"), F.col("p").cast("date")
    got = df.select(fn.retention(month, prev, "calendar").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)
    with pytest.raises(ValueError, match="must be"):
        fn.retention("m", "p", "yearly")
