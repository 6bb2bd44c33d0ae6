import datetime as dt

import pandas as pd
import pytest
from conftest import SF_DIR, rows, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom import plans, sources
from tallyloom import operators as op
from tallyloom.checks import bindings

D = dt.date(2024, 1, 10)
NOON = "2024-01-09 12:00:00"


def done(order, customer, amount, at=NOON):
    return (order, customer, 1, amount, "completed", at)


@pytest.mark.parametrize("drop_repeats", [False, True])
def test_day_bounds_and_label(make_sales, drop_repeats):
    sales = make_sales(
        done(1, 1, 1, "2024-01-08 23:59:59.999999"),
        done(2, 1, 2, "2024-01-09 00:00:00"),
        done(3, 1, 4, "2024-01-09 23:59:59.999999"),
        done(4, 1, 8, "2024-01-10 00:00:00"),
    )
    got = plans.daily_job(sales, D, drop_repeats)
    assert rows(got, "customer_id", "daily_total", "daily_orders", "date") == [(1, 6.0, 2, D)]
    assert op.on_day(sales, "created_at", D - dt.timedelta(days=1)).count() == 2


def test_column_order_of_both_layouts(make_sales):
    sales = make_sales(done(1, 1, 1))
    assert plans.daily_job(sales, D, False).columns == [
        "customer_id", "date", "daily_total", "daily_orders",
    ]
    assert plans.daily_job(sales, D, True).columns == [
        "customer_id", "daily_total", "daily_orders", "date",
    ]


def test_only_finished_sales(make_sales):
    sales = make_sales(
        done(1, 1, 1), (2, 1, 1, 5, "cancelled", NOON), (3, 1, 1, 5, None, NOON)
    )
    assert rows(plans.daily_job(sales, D), "daily_total", "daily_orders") == [(1.0, 1)]


def test_repeated_rows(make_sales):
    sales = make_sales(done(1, 1, 5), done(1, 1, 5), done(1, 1, 7))
    count = ("daily_total", "daily_orders")
    assert rows(plans.daily_job(sales, D, False), *count) == [(17.0, 3)]
    # Only the exact copy goes; the same order id with another amount stays.
    assert rows(plans.daily_job(sales, D, True), *count) == [(12.0, 2)]


def test_nulls(make_sales):
    sales = make_sales(done(1, None, 5), done(2, 1, None), done(None, 2, 3))
    got = plans.daily_job(sales, D)
    assert rows(got, "customer_id", "daily_total", "daily_orders") == [(1, 0.0, 1), (2, 3.0, 0)]


def test_backfill_is_the_union_of_single_runs(spark):
    sales = bindings.sales(spark, SF_DIR)
    start, end = dt.date(2024, 1, 8), dt.date(2024, 1, 12)
    for drop_repeats in (False, True):
        single = [
            plans.daily_job(sales, start + dt.timedelta(days=i), drop_repeats) for i in range(5)
        ]
        union = single[0]
        for one in single[1:]:
            union = union.unionByName(one)
        assert same_rows(plans.daily_backfill(sales, start, end, drop_repeats), union)


def test_days_partition_the_sales(spark):
    sales = bindings.sales(spark, SF_DIR)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]
    counts = [op.in_range(sales, "created_at", a, b).count() for a, b in zip(days, days[1:])]
    assert sum(counts) == sales.count() and all(counts)
    assert counts[:3] == [op.on_day(sales, "created_at", d).count() for d in days[:3]]


def test_bound_parameters_equal_the_column_form(spark):
    sales = bindings.sales(spark, SF_DIR)
    lo, hi = dt.date(2024, 1, 5), dt.date(2024, 1, 9)
    bound = op.sales_between(sales, lo, hi, "completed")
    assert same_rows(bound, op.completed(op.in_range(sales, "created_at", lo, hi), "status"))
    assert op.sales_between(sales, lo, hi, "x' OR '1'='1").isEmpty()


def test_append_doubles_and_upsert_does_not(spark, make_sales, tmp_path):
    sales = make_sales(done(1, 1, 5), done(2, 2, 7))
    appended = sources.daily_target(str(tmp_path / "a"))
    upserted = sources.daily_target(str(tmp_path / "u"))
    for _ in range(2):
        assert plans.run_daily(spark, sales, appended, D, write="append")
        assert plans.run_daily(spark, sales, upserted, D, write="upsert")
    columns = ("customer_id", "daily_total", "daily_orders", "date")
    once = [(1, 5.0, 1, D), (2, 7.0, 1, D)]
    assert rows(sources.read_state(spark, appended), *columns) == sorted(once * 2)
    assert rows(sources.read_state(spark, upserted), *columns) == once


def test_empty_input(spark, make_sales, new_path):
    target = sources.daily_target(new_path)
    sales = make_sales((1, 1, 1, 5, "cancelled", NOON))
    assert plans.run_daily(spark, sales, target, D) is None
    assert not sources.exists(spark, target)
    with pytest.raises(op.EmptyInput):
        plans.run_daily(spark, sales, target, D, on_empty="raise")
    with pytest.raises(ValueError):
        op.guard_nonempty(sales, on_empty="ignore")
    with pytest.raises(ValueError):
        plans.run_daily(spark, sales, target, D, write="replace")


def test_guard_passes_rows_on(make_sales):
    sales = make_sales(done(1, 1, 5))
    assert op.guard_nonempty(sales) is sales


def test_backfill_of_missed_days(spark, make_sales, new_path):
    target = sources.daily_target(new_path)
    first = make_sales(done(1, 1, 5, "2024-01-09 08:00:00"))
    plans.run_daily(spark, first, target, D)
    # The stored day has changed in the source since, but only the others are missed.
    sales = make_sales(
        done(1, 1, 50, "2024-01-09 08:00:00"),
        done(2, 1, 6, "2024-01-07 08:00:00"),
        done(3, 2, 7, "2024-01-11 08:00:00"),
        done(4, 2, 8, "2024-01-12 08:00:00"),
    )
    start, end = dt.date(2024, 1, 7), dt.date(2024, 1, 12)
    assert D not in plans.missed_run_dates(spark, target, start, end)
    plans.run_daily_backfill(spark, sales, target, start, end, only_missed=True)
    want = [(1, 5.0, D), (1, 6.0, dt.date(2024, 1, 8)), (2, 7.0, dt.date(2024, 1, 12))]
    columns = ("customer_id", "daily_total", "date")
    assert rows(sources.read_state(spark, target), *columns) == want
    plans.run_daily_backfill(spark, sales, target, start, end)
    want[0] = (1, 50.0, D)
    assert rows(sources.read_state(spark, target), *columns) == sorted(want)


def test_row_metrics_come_from_the_run_itself(spark, make_sales):
    sales = make_sales(done(1, 1, 5), done(2, 1, 6), done(3, 2, 7))
    read, extracted = op.with_row_metrics(sales, "extracted")
    stats, transformed = op.with_row_metrics(op.daily_stats(read), "transformed")
    stats.write.format("noop").mode("overwrite").save()
    assert (extracted.get["rows"], transformed.get["rows"]) == (3, 2)


@pytest.mark.parametrize("write", ["append", "upsert"])
def test_a_run_reports_its_rows(spark, make_sales, new_path, write):
    target = sources.daily_target(new_path)
    sales = make_sales(done(1, 1, 5), done(1, 1, 5), done(2, 2, 6), done(3, None, 7))
    run = dict(write=write, count_rows=True)
    kept = plans.run_daily(spark, sales, target, D, drop_repeats=False, **run)
    assert (kept.extracted, kept.written) == (4, 2)
    dropped = plans.run_daily(spark, sales, target, D, drop_repeats=True, **run)
    assert (dropped.extracted, dropped.written) == (3, 2)
    assert plans.run_daily(spark, sales, target, D, write=write) == plans.DailyRun(D)


def test_where_all(make_sales):
    sales = make_sales(done(1, 1, 5), done(2, 2, 6))
    assert op.where_all(sales).count() == 2
    assert op.where_all(sales, F.col("customer_id") == 1, F.col("amount") > 5).count() == 0


sale_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 9)),
        st.one_of(st.none(), st.integers(1, 4)),
        st.integers(1, 2),
        st.one_of(st.none(), st.integers(-500, 500)),
        st.sampled_from(["completed", "completed", "open", None]),
        st.builds("2024-01-{:02d} {:02d}:00:00".format, st.integers(8, 10), st.integers(0, 23)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(sale_rows, st.booleans())
def test_totals_equal_pandas(make_sales, data, drop_repeats):
    """Null customers are dropped and all-null totals are 0, as a pandas group-by does."""
    columns = ["order_id", "customer_id", "product_id", "amount", "status", "created_at"]
    frame = pd.DataFrame(data, columns=columns)
    frame["amount"] = frame["amount"].astype("float64")
    frame = frame[(frame["status"] == "completed") & frame["created_at"].str.startswith("2024-01-09")]
    if drop_repeats:
        frame = frame.drop_duplicates()
    groups = frame.groupby("customer_id").agg({"amount": "sum", "order_id": "count"}).reset_index()
    want = [(int(c), float(total), int(n)) for c, total, n in groups.itertuples(index=False)]
    got = plans.daily_job(make_sales(*data), D, drop_repeats)
    assert rows(got, "customer_id", "daily_total", "daily_orders") == want
