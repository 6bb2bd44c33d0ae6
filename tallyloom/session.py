"""Spark session for local runs: tests, the benchmark, a laptop.

A cluster job uses the session it is given. The jobs rely on adaptive execution (on by
default) to size shuffle partitions and to split what the writers gather by date or month.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", app: str = "tallyloom", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # No call-site record for each column expression: plans are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
