"""Refreshes that keep each customer's last active month, and refreshes that find late orders."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from conftest import SF_DIR, rows, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_incremental import before, month, order_rows

from tallyloom import operators as op
from tallyloom import sources
from tallyloom.checks import bindings
from tallyloom.plans import customer_kpi, last_active, late_orders, run_customer_kpi


@pytest.fixture(params=["path", "catalog"])
def tables(request, spark, tmp_path):
    names = ("kept_kpi", "kept_last_active", "kept_digests")
    where = [str(tmp_path / n) for n in names] if request.param == "path" else list(names)
    yield (
        sources.kpi_target(where[0]), sources.last_active_target(where[1]), sources.digests_target(where[2]),
    )
    if request.param == "catalog":
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def files(spark, target):
    """Files of each stored month."""
    name = F.input_file_name().alias("file")
    found = {}
    for m, f in sources.read_state(spark, target).select("order_month", name).distinct().collect():
        found.setdefault(m, set()).add(f)
    return found


# --- last active months ------------------------------------------------------------------------


def test_refreshes_by_kept_activity_equal_the_full_rebuild(spark, tables):
    target, kept, _ = tables
    orders = bindings.orders(spark, SF_DIR)
    stops = [dt.date(1996, 3, 10), dt.date(1996, 3, 25), dt.date(1998, 6, 15), dt.date(2002, 1, 1)]
    marks = []
    for day in stops:
        run_customer_kpi(spark, before(orders, day), target, last_active=kept)
        full = customer_kpi(before(orders, day), "calendar")
        assert same_rows(sources.read_state(spark, target), full)
        marks.append(sources.stored_parts(spark, kept))
    # Full build, the same month again, and two refreshes: one partition at any time.
    assert marks == [[], [month("1995-03")], [month("1995-03")], [month("1997-06")]]


def test_kept_rows_are_the_last_months_before_the_window(spark, make_orders, tables):
    target, kept, _ = tables
    first = [(1, 1, 10, "2019-04-05"), (2, 2, 10, "2021-01-05"), (None, 3, 10, "2019-02-01"), (3, 4, 10, "2022-05-05")]
    second = [(1, 5, 10, "2022-07-01"), (2, 6, 10, "2022-06-01")]
    third = [(1, 7, 10, "2024-08-01"), (2, 8, 10, "2024-08-01"), (4, 9, 10, "2024-08-01")]
    run_customer_kpi(spark, make_orders(*first), target, last_active=kept)
    run_customer_kpi(spark, make_orders(*first, *second), target, last_active=kept)
    columns = ("customer_id", "order_month", "before")
    at = month("2021-05")
    assert rows(sources.read_state(spark, kept), *columns) == [
        (1, month("2019-04"), at), (2, month("2021-01"), at), (None, month("2019-02"), at),
    ]
    orders = make_orders(*first, *second, *third)
    for lookback in (0, 0, 1, 30):
        run_customer_kpi(spark, orders, target, lookback, last_active=kept)
        assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))


def test_a_longer_lookback_leaves_the_kept_rows(spark, make_orders, tables):
    target, kept, _ = tables
    data = [(1, i, 10, f"20{20 + i // 12}-{i % 12 + 1:02d}-03") for i in range(48)]
    run_customer_kpi(spark, make_orders(*data[:40]), target, last_active=kept)
    run_customer_kpi(spark, make_orders(*data), target, last_active=kept)
    held = sources.stored_parts(spark, kept)
    run_customer_kpi(spark, make_orders(*data), target, lookback_months=20, last_active=kept)
    assert sources.stored_parts(spark, kept) == held
    assert same_rows(sources.read_state(spark, target), customer_kpi(make_orders(*data), "calendar"))


def test_a_full_build_forgets(spark, make_orders, tables):
    target, kept, _ = tables
    data = [(1, 1, 10, "2019-04-05"), (1, 2, 10, "2024-01-05")]
    for _ in range(2):
        run_customer_kpi(spark, make_orders(*data), target, last_active=kept)
    assert sources.stored_parts(spark, kept) == [month("2023-01")]
    op.materialize(sources.read_state(spark, target).limit(0), target)
    run_customer_kpi(spark, make_orders(*data), target, last_active=kept)
    assert sources.stored_parts(spark, kept) == []


def test_a_lost_job_leaves_the_former_rows(spark, make_orders, tables, monkeypatch):
    target, kept, _ = tables
    first = [(1, 1, 10, "2019-04-05"), (2, 2, 10, "2020-01-05"), (2, 3, 10, "2022-01-05")]
    run_customer_kpi(spark, make_orders(*first), target, last_active=kept)
    run_customer_kpi(spark, make_orders(*first), target, last_active=kept)
    held = rows(sources.read_state(spark, kept), "customer_id", "order_month", "before")
    orders = make_orders(*first, (2, 4, 10, "2023-03-05"))
    run_customer_kpi(spark, orders, target)  # the mark moves on
    with monkeypatch.context() as m:
        m.setattr(last_active, "replace_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_customer_kpi(spark, orders, target, last_active=kept)
    assert rows(sources.read_state(spark, kept), "customer_id", "order_month", "before") == held
    with monkeypatch.context() as m:  # lost after the new rows were written
        m.setattr(last_active, "drop_partition", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_customer_kpi(spark, orders, target, last_active=kept)
    run_customer_kpi(spark, orders, target, last_active=kept)
    assert sources.stored_parts(spark, kept) == [month("2022-03")]
    assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))


def test_the_active_lookback_keeps_nothing(spark, make_orders, tables):
    target = sources.kpi_target(tables[0].location, lookback="active")
    for kept in ({"last_active": tables[1]}, {"digests": tables[2]}):
        with pytest.raises(ValueError, match="built in full"):
            run_customer_kpi(spark, make_orders((1, 1, 1, "2024-01-01")), target, **kept)


def test_bytes_read_stay_flat_while_the_history_grows_tenfold(tmp_path):
    job = os.path.join(os.path.dirname(__file__), "refresh_bytes_job.py")
    out = subprocess.run(
        [sys.executable, job, str(tmp_path)], capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-3000:]
    short, long, without_short, without_long = map(int, out.stdout.split()[-4:])
    assert long < 1.2 * short
    assert without_long > 2.5 * without_short  # what the kept rows save


# --- late orders --------------------------------------------------------------------------------


def test_a_late_order_in_any_old_month_is_found(spark, tables):
    target, _, digests = tables
    orders = bindings.orders(spark, SF_DIR)
    hidden = (F.col("order_id") % 97 == 0) & (F.month("order_date") == 5)
    early = before(orders, dt.date(2000, 6, 15))
    run_customer_kpi(spark, early.where(~hidden), target, digests=digests)
    run_customer_kpi(spark, orders, target, digests=digests)
    assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))


def test_only_dependent_months_are_rewritten(spark, make_orders, tables):
    target, _, digests = tables
    data = [(1, i, 10, f"20{20 + i // 12}-{i % 12 + 1:02d}-03") for i in range(48)]
    data += [(2, 100, 10, "2020-02-03"), (2, 101, 10, "2021-11-03")]
    run_customer_kpi(spark, make_orders(*data), target, digests=digests)
    old = files(spark, target)
    late = (2, 102, 10, "2020-06-10")  # now the last active month before 2021-11
    run_customer_kpi(spark, make_orders(*data, late), target, digests=digests)
    new = files(spark, target)
    rewritten = {m for m in new if new[m] != old[m]}
    want = ["2020-06", "2020-07", "2021-06", "2021-11", "2023-12"]
    assert rewritten == set(map(month, want))
    full = customer_kpi(make_orders(*data, late), "calendar")
    assert same_rows(sources.read_state(spark, target), full)
    # Nothing is late any more: the last month alone is computed anew.
    run_customer_kpi(spark, make_orders(*data, late), target, digests=digests)
    again = files(spark, target)
    assert {m for m in again if again[m] != new[m]} == {month("2023-12")}


def test_late_orders_are_ignored_unless_asked_for(spark, make_orders, tables):
    target, _, _ = tables
    data = [(1, 1, 10, "2024-01-05"), (1, 2, 10, "2024-03-05")]
    run_customer_kpi(spark, make_orders(*data), target)
    run_customer_kpi(spark, make_orders(*data, (1, 3, 10, "2024-02-05")), target)
    assert sources.read_state(spark, target).count() == 2


def test_removed_and_changed_orders_and_months_that_left(spark, make_orders, tables):
    target, _, digests = tables
    data = [
        (1, 1, 10, "2023-01-05"), (2, 2, 10, "2023-01-06"), (1, 3, 10, "2023-02-05"),
        (2, 4, 10, "2023-03-05"), (3, 5, 10, "2022-05-05"), (1, 6, 10, "2024-02-01"),
    ]
    run_customer_kpi(spark, make_orders(*data), target, digests=digests)
    changed = [data[0], data[2], (2, 4, 99, "2023-03-05"), data[5]]  # 2 left January, 4 costs more
    run_customer_kpi(spark, make_orders(*changed), target, digests=digests)
    stored = sources.read_state(spark, target)
    kept = stored.where("order_month = DATE '2022-05-01'")  # its orders have left the source
    assert kept.count() == 1
    full = customer_kpi(make_orders(*changed, data[4]), "calendar")
    assert same_rows(stored, full)
    assert month("2022-05") in late_orders.noted_digests(spark, digests)


def test_a_digest_tells_nulls_and_repeats_apart(make_orders):
    def digest(*data):
        return [tuple(r) for r in late_orders.month_digests(make_orders(*data)).collect()]

    at = "2024-01-05"
    assert digest((None, 5, 1, at)) != digest((5, None, 1, at))
    assert digest((1, 5, 1, at)) != digest((1, 5, 1, at), (1, 5, 1, at))
    assert digest((1, 5, 1, at), (2, 6, 1, at)) == digest((2, 6, 1, at), (1, 5, 1, "2024-01-09"))
    assert digest((1, 5, 1, at, "open")) == digest() == digest((1, 5, 1, None))


def test_a_target_made_without_digests_is_noted_first(spark, make_orders, tables):
    target, _, digests = tables
    data = [(1, 1, 10, "2024-01-05"), (1, 2, 10, "2024-03-05")]
    run_customer_kpi(spark, make_orders(*data), target)
    run_customer_kpi(spark, make_orders(*data), target, digests=digests)
    more = make_orders(*data, (1, 3, 10, "2024-02-05"))
    run_customer_kpi(spark, more, target, digests=digests)
    assert same_rows(sources.read_state(spark, target), customer_kpi(more, "calendar"))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(order_rows, order_rows, st.dates(dt.date(2022, 2, 1), dt.date(2024, 12, 31)), st.integers(0, 4))
def test_any_history_equals_the_full_rebuild(spark, make_orders, tmp_path_factory, first, more, day, drop):
    """Built, changed in any months, refreshed twice, with and without kept activity."""
    folder = tmp_path_factory.mktemp("kept")
    target = sources.kpi_target(f"{folder}/kpi")
    how = {
        "last_active": sources.last_active_target(f"{folder}/active"),
        "digests": sources.digests_target(f"{folder}/digests"),
    }
    run_customer_kpi(spark, before(make_orders(*first), day), target, **how)
    # Some orders go, but not the last one of a month: months that leave keep their rows.
    months = {r[3][:7] for r in first[drop:]}
    kept = first[drop:] + [r for r in first[:drop] if r[3][:7] not in months]
    orders = make_orders(*kept, *more)
    for _ in range(2):
        run_customer_kpi(spark, orders, target, **how)
        assert same_rows(sources.read_state(spark, target), customer_kpi(orders, "calendar"))
