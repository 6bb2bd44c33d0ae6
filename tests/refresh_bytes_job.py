"""Run by test_upkeep.py in its own process: bytes that a refresh reads of short and long histories."""

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from tallyloom import plans, sources
from tallyloom.session import local_session

CUSTOMERS = 1500


def history(spark, months: int):
    """Orders of ``months`` months up to December 2023; each customer buys in every one."""
    day = f"add_months(date'2023-12-05', -cast(id % {months} as int))"
    return spark.range(CUSTOMERS * months).select(
        (F.col("id") / months).cast("long").alias("customer_id"),
        F.col("id").alias("order_id"),
        F.lit("10").cast("decimal(18,2)").alias("order_amount"),
        F.expr(f"cast({day} as timestamp_ntz)").alias("order_date"),
        F.lit("completed").alias("order_status"),
    )


def bytes_read(folder: str, group: str) -> int:
    """Input of all tasks of a job group, from the event log."""
    total, stages = 0, set()
    for path in glob.glob(f"{folder}/events/*"):
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                if (e.get("Properties") or {}).get("spark.jobGroup.id") == group:
                    stages.update(e["Stage IDs"])
            elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                total += e["Task Metrics"]["Input Metrics"]["Bytes Read"]
    return total


def main(folder: str) -> None:
    os.makedirs(f"{folder}/events")
    spark = local_session(
        4, "bytes",
        **{
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{folder}/events",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    for kept in (True, False):
        for months in (24, 240):
            name = f"{months}-{kept}"
            history(spark, months).write.parquet(f"{folder}/{name}/orders")
            # The source's own scan is not what is measured: only the last months' orders are given.
            orders = sources.read_orders(spark, f"{folder}/{name}/orders")
            recent = orders.where("order_date >= timestamp_ntz'2023-12-01'")
            recent.write.parquet(f"{folder}/{name}/recent")
            recent = sources.read_orders(spark, f"{folder}/{name}/recent")
            target = sources.kpi_target(f"{folder}/{name}/kpi")
            how = {"last_active": sources.last_active_target(f"{folder}/{name}/active")} if kept else {}
            plans.run_customer_kpi(spark, orders, target, **how)
            plans.run_customer_kpi(spark, recent, target, **how)
            spark.sparkContext.setJobGroup(name, name)
            plans.run_customer_kpi(spark, recent, target, **how)
            spark.sparkContext.setJobGroup("other", "other")
    spark.stop()
    print(*[bytes_read(folder, f"{m}-{k}") for k in (True, False) for m in (24, 240)])


if __name__ == "__main__":
    main(*sys.argv[1:])
