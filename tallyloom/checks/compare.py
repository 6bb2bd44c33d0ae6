"""Run a registered query in Spark and its SQL in DuckDB and compare the rows exactly."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types and rows; empty when equal."""
    want = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(want.columns):
        return [f"columns {names} != {sorted(want.columns)}"]
    have_types = dict(df.dtypes)
    want_types = dict(zip(want.columns, (str(t) for t in want.types)))
    found = [
        f"type of {n}: {have_types[n]} != {want_types[n]}"
        for n in names
        if SAME_TYPE.get(want_types[n]) != have_types[n]
    ]
    have_rows = Counter(tuple(r) for r in df.select(*names).collect())
    want_rows = Counter(want.project(", ".join(f'"{n}"' for n in names)).fetchall())
    for label, rows in (("Spark", have_rows - want_rows), ("DuckDB", want_rows - have_rows)):
        if rows:
            found.append(f"{sum(rows.values())} rows in {label} only, e.g. {next(iter(rows))}")
    return found
