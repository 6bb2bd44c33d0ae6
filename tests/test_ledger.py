"""Run dates that are noted, scans that shrink, and balanced slices."""

import datetime as dt

import pytest
from conftest import final_plan, rows, same_rows
from hypothesis import given
from hypothesis import strategies as st

from tallyloom import plans, sources
from tallyloom.plans import daily as daily_plans

DAY = dt.timedelta(days=1)
D = lambda n: dt.date(2024, 1, 1) + n * DAY


@pytest.fixture
def tables(tmp_path):
    return sources.daily_target(str(tmp_path / "daily")), sources.ledger_target(str(tmp_path / "ledger"))


def sales_on(make_sales, *days):
    return make_sales(*[(i, 7, 1, 10, "completed", f"{d}T10:00") for i, d in enumerate(days)])


def test_empty_days_are_computed_once(spark, make_sales, tables):
    target, ledger = tables
    sales = sales_on(make_sales, D(1), D(5), D(40))
    how = {"only_missed": True, "ledger": ledger}
    first = plans.run_daily_backfill(spark, sales, target, D(1), D(45), **how)
    assert first == [D(i) for i in range(1, 46)]
    assert plans.run_daily_backfill(spark, sales, target, D(1), D(45), **how) == []
    assert plans.run_daily_backfill(spark, sales, target, D(1), D(48), **how) == [D(46), D(47), D(48)]
    noted = plans.noted_run_dates(spark, ledger, D(1), D(48))
    assert len(noted) == 48 and [d for d, has in noted.items() if has] == [D(2), D(6), D(41)]
    assert same_rows(sources.read_state(spark, target), plans.daily_table(sales))
    # Without the ledger each empty day counts as missed for ever.
    assert len(plans.missed_run_dates(spark, target, D(1), D(48))) == 45


def test_single_runs_are_noted(spark, make_sales, tables):
    target, ledger = tables
    sales = sales_on(make_sales, D(1))
    assert plans.run_daily(spark, sales, target, D(2), ledger=ledger)
    assert plans.run_daily(spark, sales, target, D(3), ledger=ledger) is None
    assert plans.noted_run_dates(spark, ledger, D(0), D(9)) == {D(2): True, D(3): False}
    assert plans.missed_run_dates(spark, target, D(2), D(5), ledger) == [D(4), D(5)]
    plans.run_daily(spark, sales_on(make_sales, D(1), D(2)), target, D(3), ledger=ledger)
    assert plans.noted_run_dates(spark, ledger, D(0), D(9)) == {D(2): True, D(3): True}


def test_days_stored_before_there_was_a_ledger_are_not_missed(spark, make_sales, tables):
    target, ledger = tables
    sales = sales_on(make_sales, D(1), D(3))
    plans.run_daily_backfill(spark, sales, target, D(1), D(5))
    how = {"only_missed": True, "ledger": ledger}
    assert plans.run_daily_backfill(spark, sales, target, D(1), D(5), **how) == [D(1), D(3), D(5)]
    assert plans.run_daily_backfill(spark, sales, target, D(1), D(5), **how) == []


def test_a_day_lost_before_it_is_noted_is_computed_again(spark, make_sales, tables, monkeypatch):
    target, ledger = tables
    sales = sales_on(make_sales, D(1))
    with monkeypatch.context() as m:
        m.setattr(daily_plans, "_note", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            plans.run_daily_backfill(spark, sales, target, D(1), D(4), ledger=ledger)
    how = {"only_missed": True, "ledger": ledger}
    assert plans.run_daily_backfill(spark, sales, target, D(1), D(4), **how) == [D(1), D(3), D(4)]
    assert same_rows(sources.read_state(spark, target), plans.daily_table(sales))


def test_gaps_reach_the_scan(spark, make_sales, tmp_path):
    sales_on(make_sales, D(1), D(100)).write.parquet(str(tmp_path / "sales"))
    sales = sources.read_sales(spark, str(tmp_path / "sales"))
    plan = final_plan(daily_plans._sales_of(sales, [D(2), D(3), D(101)]))
    pushed = plan[plan.index("PushedFilters") :]
    assert "2024-01-02T00:00" in pushed and "2024-01-04T00:00" in pushed
    assert "2024-04-10T00:00" in pushed and "2024-04-11T00:00" in pushed
    assert " IN " not in plan.replace("INSET", "")


@given(st.sets(st.integers(0, 60), min_size=1), st.integers(1, 8))
def test_ranges_cover_the_days(days, most):
    days = [D(i) for i in sorted(days)]
    ranges = daily_plans.day_ranges(days, most)
    covered = [a + i * DAY for a, b in ranges for i in range((b - a).days)]
    assert len(ranges) <= most and set(days) <= set(covered) and covered == sorted(set(covered))
    runs = 1 + sum((b - a).days > 1 for a, b in zip(days, days[1:]))
    if runs <= most:
        assert covered == days


# --- slices of a database -------------------------------------------------------------------------


def parsed(slices):
    at = lambda t: dt.datetime.fromisoformat(t.strip().split("'")[1])
    return [tuple(map(at, s.split(" AND "))) for s in slices]


hours = st.lists(st.tuples(st.integers(-3, 80), st.integers(0, 1000)), max_size=60, unique_by=lambda x: x[0])


@given(hours, st.integers(1, 40))
def test_slices_cover_all_and_are_of_like_size(counted, n_slices):
    lo = dt.datetime(2024, 1, 1)
    counts = [(lo + dt.timedelta(hours=h), n) for h, n in counted]
    edges = parsed(sources.balanced_slices(counts, D(0), D(3), n_slices))
    assert edges[0][0] == lo and edges[-1][1] == lo + 3 * DAY
    assert all(a < b for a, b in edges) and all(x[1] == y[0] for x, y in zip(edges, edges[1:]))
    assert len(edges) <= n_slices
    inside = [(h, n) for h, n in counts if lo <= h < lo + 3 * DAY]
    share = -(-sum(n for _, n in inside) // n_slices)
    for a, b in edges:
        own = [n for h, n in inside if a <= h < b]
        # A share, the hour in which it was reached, and a neighbour that was joined to it.
        assert sum(own) <= 3 * share + 2 * max([n for _, n in inside], default=0)


def test_a_quiet_and_a_busy_hour():
    lo = dt.datetime(2024, 1, 1)
    counts = [(lo + dt.timedelta(hours=h), 10) for h in range(24)] + [(lo + dt.timedelta(hours=30), 2400)]
    edges = parsed(sources.balanced_slices(counts, D(0), D(2), 11))
    busy = [(a, b) for a, b in edges if a >= lo + dt.timedelta(hours=30) and b <= lo + dt.timedelta(hours=31)]
    assert len(edges) <= 11 and len(busy) >= 8
    by_time = sources.jdbc_day_slices(D(0), D(2), 5)
    assert len(by_time) == 10  # of these one would hold all but 240 rows


def test_nothing_counted_and_bad_bounds():
    assert len(sources.balanced_slices([], D(0), D(2), 5)) == 1
    for bad in ((D(0), D(0), 5), (D(0), D(1), 0)):
        with pytest.raises(ValueError):
            sources.balanced_slices([], *bad)


def test_the_statement_that_counts(spark, make_sales):
    sales = sales_on(make_sales, D(1), D(1), D(2), D(9))
    sales.createOrReplaceTempView("sales_to_count")
    counted = spark.sql(sources.hour_counts_query("sales_to_count", D(0), D(5)))
    assert rows(counted, "n") == [(1,), (2,)]
    got = [(h.replace(tzinfo=None), n) for h, n in counted.collect()]
    assert len(parsed(sources.balanced_slices(got, D(0), D(5), 2))) == 2
