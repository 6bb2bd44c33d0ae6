"""Run by test_retries.py in its own process: every first task attempt over the input fails."""

import sys

from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyloom import plans, sources
from tallyloom.checks import bindings
from tallyloom.functions import at_midnight
from tallyloom.session import local_session


def fail_first_attempt(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
        if context.attemptNumber() == 0:
            raise RuntimeError("lost on purpose")


def main(sf_dir: str, out: str) -> None:
    spark = local_session("8,3", "retries", **{"spark.checkpoint.dir": f"{out}/shared"})
    spark.sparkContext.setLogLevel("OFF")
    orders = bindings.orders(spark, sf_dir).repartition(4, "order_id")
    failing = orders.mapInArrow(fail_first_attempt, orders.schema)
    target = sources.kpi_target(f"{out}/kpi")
    early = F.col("order_date") < at_midnight(bindings.SPLIT.date())
    plans.run_customer_kpi(spark, failing.where(early), target)
    plans.run_customer_kpi(spark, failing, target)
    stored = sources.read_state(spark, target)
    want = plans.customer_kpi(orders, "calendar")
    assert stored.count() == want.count() > 0
    assert stored.exceptAll(want).isEmpty()

    sales = bindings.sales(spark, sf_dir).repartition(4, "order_id")
    failing = sales.mapInArrow(fail_first_attempt, sales.schema)
    daily = sources.daily_target(f"{out}/daily")
    for _ in range(2):
        plans.run_daily_backfill(
            spark, failing, daily, bindings.BACKFILL_START, bindings.BACKFILL_END
        )
    stored, want = sources.read_state(spark, daily), plans.daily_table(sales)
    assert stored.count() == want.count() > 0
    assert stored.exceptAll(want).isEmpty()
    print("same rows")


if __name__ == "__main__":
    main(*sys.argv[1:])
