"""Headline timings. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
All queries run twice to warm up, then three times; the median counts. The single daily runs are timed once, cold.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyloom import operators as op  # noqa: E402
from tallyloom import plans, sources  # noqa: E402
from tallyloom.checks import bindings  # noqa: E402
from tallyloom.checks.queries import kpi_by_joins  # noqa: E402
from tallyloom.functions import at_midnight  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP = 2
RUNS = 3

# What the total counts. The other timings are the slower shapes they replace.
HEADLINE = (
    "customer_kpi_full",
    "customer_kpi_calendar",
    "kpi_refresh_last_month",
    "daily_job_v1",
    "daily_job_v2",
    "backfill_one_job",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark) -> dict:
    orders = bindings.orders(spark, SF_DIR)
    sales = bindings.sales(spark, SF_DIR)
    finished = op.completed(orders, "order_status")
    last_day = finished.agg(F.max("order_date")).first()[0]
    months = op.monthly_orders(finished)
    last_month = last_day.date().replace(day=1)
    target = sources.kpi_target(sources.scratch_dir(spark))
    plans.run_customer_kpi(
        spark, orders.where(F.col("order_date") < at_midnight(last_month)), target
    )
    rebuilt = sources.kpi_target(sources.scratch_dir(spark))

    first, last = sales.agg(F.min("created_at"), F.max("created_at")).first()
    one_day = dt.timedelta(days=1)
    run_dates = [first.date() + one_day * i for i in range(1, (last.date() - first.date()).days + 2)]
    backfilled = sources.daily_target(sources.scratch_dir(spark))
    singly = sources.daily_target(sources.scratch_dir(spark))

    def self_joins() -> DataFrame:
        one = op.lookup(months, months, 1, {
            "monthly_orders": "prev_month_orders",
            "monthly_revenue": "prev_month_revenue",
            "avg_order_value": "prev_avg_order_value",
        })
        return op.lookup(one, months, 12, {"monthly_orders": "prev_year_orders"})

    def single_runs() -> None:
        for run_date in run_dates:
            plans.run_daily(spark, sales, singly, run_date)

    return {
        "customer_kpi_full": lambda: consume(plans.customer_kpi(orders, ordered=True)),
        "customer_kpi_calendar": lambda: consume(plans.customer_kpi(orders, "calendar")),
        "kpi_refresh_last_month": lambda: plans.run_customer_kpi(spark, orders, target),
        "daily_job_v1": lambda: consume(plans.daily_job(sales, bindings.RUN_DATE, False)),
        "daily_job_v2": lambda: consume(plans.daily_job(sales, bindings.RUN_DATE, True)),
        "backfill_one_job": lambda: plans.run_daily_backfill(
            spark, sales, backfilled, run_dates[0], run_dates[-1]
        ),
        "baseline_kpi_by_joins": lambda: consume(op.sort_kpi(kpi_by_joins(months))),
        "baseline_calendar_self_joins": lambda: consume(self_joins()),
        "calendar_window": lambda: consume(op.previous_calendar(months).drop("prev_order_month")),
        "baseline_kpi_rebuild_and_write": lambda: op.materialize(
            plans.customer_kpi(orders, "calendar"), rebuilt
        ),
        "baseline_backfill_single_runs": single_runs,
    }


def main() -> None:
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = local_session(CPUS, "bench", **conf)
    spark.sparkContext.setLogLevel("OFF")
    runs = cases(spark)
    slow = "baseline_backfill_single_runs"  # a job per day: once is enough
    times: dict[str, list[float]] = {name: [] for name in runs}
    for i in range(WARM_UP + RUNS):
        for name, run in runs.items():
            if name == slow and i < WARM_UP + RUNS - 1:
                continue
            start = time.perf_counter()
            run()
            if i >= WARM_UP:
                times[name].append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(t), 4) for name, t in times.items()}
    total = round(sum(seconds[n] for n in HEADLINE), 4)
    line = {
        "metric": "headline_total",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
