import datetime as dt

import pytest
from conftest import SF_DIR, rows, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom import operators as op
from tallyloom import sources
from tallyloom.checks import bindings
from tallyloom.functions import at_midnight
from tallyloom.plans import customer_kpi, customer_kpi_incremental, run_customer_kpi


def month(text):
    return dt.date.fromisoformat(text + "-01")


def before(orders, day):
    return orders.where(F.col("order_date") < at_midnight(day))


@pytest.mark.parametrize(
    "day", [dt.date(1996, 2, 1), dt.date(1998, 6, 15), dt.date(2000, 12, 31), dt.date(2001, 7, 20)]
)
def test_refresh_equals_the_full_rebuild(spark, day):
    orders = bindings.orders(spark, SF_DIR)
    full = customer_kpi(orders, "calendar")
    state = customer_kpi(before(orders, day), "calendar")
    mark = op.high_water_mark(state)
    batch = customer_kpi_incremental(orders, state)
    assert same_rows(batch, full.where(F.col("order_month") >= F.lit(mark)))


def test_two_refreshes_equal_the_full_rebuild(spark, new_path):
    orders = bindings.orders(spark, SF_DIR)
    target = sources.kpi_target(new_path)
    assert run_customer_kpi(spark, before(orders, dt.date(1997, 3, 10)), target) is None
    assert run_customer_kpi(spark, before(orders, dt.date(1999, 3, 10)), target) == month("1997-03")
    assert run_customer_kpi(spark, orders, target) == month("1999-03")
    full = customer_kpi(orders, "calendar")
    assert same_rows(sources.read_state(spark, target), full)
    run_customer_kpi(spark, orders, target)
    assert same_rows(sources.read_state(spark, target), full)


def test_catalog_table(spark):
    orders = bindings.orders(spark, SF_DIR)
    target = sources.kpi_target("kpi_in_catalog")
    run_customer_kpi(spark, before(orders, dt.date(2000, 3, 10)), target)
    run_customer_kpi(spark, orders, target)
    assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))
    spark.sql("DROP TABLE kpi_in_catalog")


def test_a_recomputed_month_counts_with_its_new_values(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    jan = [(1, 1, 10, "2024-01-05")]
    more = [(1, 2, 10, "2024-01-20"), (1, 3, 10, "2024-02-05")]
    run_customer_kpi(spark, make_orders(*jan), target)
    run_customer_kpi(spark, make_orders(*jan, *more), target)
    columns = ("order_month", "monthly_orders", "prev_month_orders", "retention_status")
    assert rows(sources.read_state(spark, target), *columns) == [
        (month("2024-01"), 2, None, "New"), (month("2024-02"), 1, 2, "Retained"),
    ]


def test_a_stored_month_without_new_rows_is_still_looked_back_to(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    run_customer_kpi(spark, make_orders((1, 1, 10, "2024-01-05"), (2, 2, 10, "2024-01-06")), target)
    # Customer 2's January has left the source; the stored row stays and counts.
    run_customer_kpi(spark, make_orders((1, 1, 10, "2024-01-05"), (2, 3, 30, "2024-02-06")), target)
    columns = ("customer_id", "order_month", "prev_month_orders", "revenue_mom_growth_pct")
    assert rows(sources.read_state(spark, target), *columns) == [
        (1, month("2024-01"), None, None),
        (2, month("2024-01"), None, None),
        (2, month("2024-02"), 1, 200.0),
    ]


def test_previous_active_month_far_back(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    old = [(1, 1, 10, "2019-04-05"), (2, 2, 10, "2024-01-05")]
    run_customer_kpi(spark, make_orders(*old), target)
    new = [
        (1, 3, 10, "2024-05-01"), (3, 4, 10, "2024-05-01"),
        (2, 5, 10, "2024-02-01"), (2, 6, 10, "2024-05-01"),
    ]
    run_customer_kpi(spark, make_orders(*old, *new), target)
    columns = ("customer_id", "order_month", "retention_status")
    assert rows(sources.read_state(spark, target), *columns) == [
        (1, month("2019-04"), "New"),
        (1, month("2024-05"), "Retained"),  # month numbers 5 and 4
        (2, month("2024-01"), "New"),
        (2, month("2024-02"), "Retained"),
        (2, month("2024-05"), "Reactivated"),
        (3, month("2024-05"), "New"),
    ]


def test_an_empty_target_is_loaded_in_full(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    op.materialize(customer_kpi(make_orders((1, 1, 1, "2024-01-01", "open")), "calendar"), target)
    orders = make_orders((1, 1, 10, "2024-01-05"))
    assert op.since_high_water_mark(orders, sources.read_state(spark, target)) is orders
    assert run_customer_kpi(spark, orders, target) is None
    assert sources.read_state(spark, target).count() == 1


def test_the_mark_is_taken_from_partitions_that_hold_rows(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    early = [(1, 1, 10, "2024-01-05"), (1, 2, 10, None)]
    run_customer_kpi(spark, make_orders(*early), target)
    later = sources.read_state(spark, target).where("order_month = DATE '2024-01-01'").limit(0)
    later.drop("order_month").write.parquet(f"{new_path}/order_month=2024-07-01")
    assert sources.stored_parts(spark, target)[0] == month("2024-07")
    more = make_orders(*early, (1, 3, 10, "2024-02-05"))
    assert run_customer_kpi(spark, more, target) == month("2024-01")
    assert same_rows(
        sources.read_state(spark, target).where("order_month is not null"),
        customer_kpi(more, "calendar").where("order_month is not null"),
    )


def test_late_orders_need_a_lookback(spark, make_orders, tmp_path):
    early = [(1, 1, 10, "2024-01-05"), (1, 2, 10, "2024-03-05")]
    late = (1, 3, 10, "2024-02-05")
    for lookback, want in ((0, 2), (1, 3)):
        target = sources.kpi_target(str(tmp_path / str(lookback)))
        run_customer_kpi(spark, make_orders(*early), target)
        run_customer_kpi(spark, make_orders(*early, late), target, lookback_months=lookback)
        assert sources.read_state(spark, target).count() == want


def test_null_keys_survive_a_refresh(spark, make_orders, new_path):
    target = sources.kpi_target(new_path)
    orders = make_orders(
        (None, 1, 10, "2024-01-05"), (None, 2, 10, "2024-02-05"), (1, 3, 10, "2024-02-05"), (1, 4, 10, None)
    )
    for _ in range(2):
        run_customer_kpi(spark, orders, target)
        assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))


order_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 3)),
        st.one_of(st.none(), st.integers(1, 30)),
        st.one_of(st.none(), st.integers(1, 9000)),
        st.builds("{}-{:02d}-1{}".format, st.integers(2022, 2024), st.integers(1, 12), st.integers(0, 9)),
    ),
    min_size=2,
    max_size=50,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(order_rows, st.dates(dt.date(2022, 2, 1), dt.date(2024, 12, 31)), st.integers(0, 3))
def test_any_refresh_equals_the_full_rebuild(make_orders, data, day, lookback_months):
    orders = make_orders(*data)
    full = customer_kpi(orders, "calendar")
    state = customer_kpi(before(orders, day), "calendar")
    batch = customer_kpi_incremental(orders, state, lookback_months)
    mark = op.high_water_mark(state, lookback_months)
    want = full if mark is None else full.where(F.col("order_month") >= F.lit(mark))
    assert same_rows(batch, want)
