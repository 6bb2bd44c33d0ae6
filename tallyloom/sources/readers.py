"""Typed readers."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_WIDENED_FROM = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType),
    T.TimestampNTZType: (T.DateType,),
}


class SchemaMismatch(ValueError):
    """A source lacks a column or has it in a type that cannot be widened."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and types.

    Integers are widened, a date becomes its midnight, and any decimal is kept as it is.
    Everything else must match: a guessed cast of text, doubles or zoned timestamps would
    change results silently. Filters still reach the scan through the casts.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise SchemaMismatch(f"missing columns: {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        have, want = found[field.name], field.dataType
        if have == want or (isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType)):
            columns.append(F.col(field.name))
        elif isinstance(have, _WIDENED_FROM.get(type(want), ())):
            columns.append(F.col(field.name).cast(want).alias(field.name))
        else:
            raise SchemaMismatch(
                f"column {field.name} is {have.simpleString()}, expected "
                f"{want.simpleString()}: cast it before the call"
            )
    return df.select(*columns)


def table_name(schema: str, table: str | None = None, catalog: str | None = None) -> str:
    """``[catalog.]schema.table``, quoted; a table alone is one of ``public``. Only plain identifiers."""
    if table is None:
        schema, table = "public", schema
    parts = [schema, table] if catalog is None else [catalog, schema, table]
    for part in parts:
        if not _IDENTIFIER.fullmatch(part):
            raise ValueError(f"not a plain identifier: {part!r}")
    return ".".join(f"`{part}`" for part in parts)


def _load(spark: SparkSession, src: DataFrame | str) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    return spark.read.parquet(src) if "/" in src else spark.table(src)


def read_sales(spark: SparkSession, src: DataFrame | str) -> DataFrame:
    """Sales rows from a DataFrame, a table name or a Parquet path."""
    return conform(_load(spark, src), schemas.SALES)


def read_orders(spark: SparkSession, src: DataFrame | str) -> DataFrame:
    """Staged orders from a DataFrame, a table name or a Parquet path."""
    return conform(_load(spark, src), schemas.ORDERS)


def jdbc_day_slices(lo: dt.date, hi: dt.date, slices_per_day: int) -> list[str]:
    """Half-open ``created_at`` ranges covering [lo, hi), one JDBC partition each."""
    if slices_per_day < 1 or hi <= lo:
        raise ValueError("need lo < hi and at least one slice a day")
    start = dt.datetime.combine(lo, dt.time())
    n = (hi - lo).days * slices_per_day
    edges = [start + i * dt.timedelta(days=1) / slices_per_day for i in range(n + 1)]
    return [
        f"created_at >= TIMESTAMP '{a}' AND created_at < TIMESTAMP '{b}'"
        for a, b in zip(edges, edges[1:])
    ]


def balanced_slices(
    counts: list[tuple[dt.datetime, int]], lo: dt.date, hi: dt.date, n_slices: int
) -> list[str]:
    """Half-open ``created_at`` ranges covering [lo, hi) with like numbers of rows, ``n_slices`` at most.

    ``counts`` are rows by hour, in any order; hours without rows may be missing. A slice ends with the
    hour in which its share of the rows is reached, so it has at most a share and an hour too many. An
    hour that holds several shares is cut into as many parts of equal time.
    """
    if n_slices < 1 or hi <= lo:
        raise ValueError("need lo < hi and at least one slice")
    begin, end = (dt.datetime.combine(d, dt.time()) for d in (lo, hi))
    hours = sorted((h, n) for h, n in counts if begin <= h < end and n > 0)
    share = max(1, -(-sum(n for _, n in hours) // n_slices))
    edges, held, one_hour = [begin], 0, dt.timedelta(hours=1)
    for hour, n in hours:
        parts = n // share
        if parts > 1:  # the hour alone fills slices
            edges += [hour + i * one_hour / parts for i in range(parts)] + [hour + one_hour]
            held = 0
            continue
        held += n
        if held >= share:
            edges.append(hour + one_hour)
            held = 0
    edges = sorted({e for e in edges if e < end}) + [end]
    # Cuts around full hours can make more slices than asked for: empty stretches go with the next.
    while len(edges) - 1 > n_slices:
        size = [sum(n for h, n in hours if a <= h < b) for a, b in zip(edges, edges[1:])]
        least = min(range(len(size) - 1), key=lambda i: size[i] + size[i + 1])
        del edges[least + 1]
    return [
        f"created_at >= TIMESTAMP '{a}' AND created_at < TIMESTAMP '{b}'"
        for a, b in zip(edges, edges[1:])
    ]


def hour_counts_query(table: str, lo: dt.date, hi: dt.date) -> str:
    """The statement by which a database counts the rows of each hour of the days [lo, hi)."""
    return (
        f"SELECT date_trunc('hour', created_at) AS hour, count(*) AS n FROM {table} "
        f"WHERE created_at >= TIMESTAMP '{lo} 00:00:00' AND created_at < TIMESTAMP '{hi} 00:00:00' GROUP BY 1"
    )


def read_jdbc_sales(
    spark: SparkSession,
    url: str,
    table: str,
    lo: dt.date,
    hi: dt.date,
    slices_per_day: int = 24,
    properties: dict[str, str] | None = None,
    balanced: bool = False,
) -> DataFrame:
    """Sales of the days [lo, hi) over JDBC.

    Without slices one connection, hence one task, would read everything. Column selection
    and later filters are pushed into each slice's statement. ``balanced`` has the database count the
    rows of each hour first, and cuts slices of like size; otherwise they are of like duration.
    """
    slices = jdbc_day_slices(lo, hi, slices_per_day)
    reader = spark.read.option("preferTimestampNTZ", "true")
    if balanced:
        counted = reader.jdbc(url, f"({hour_counts_query(table, lo, hi)}) AS hours", properties=properties)
        slices = balanced_slices(list(map(tuple, counted.collect())), lo, hi, len(slices))
    return conform(reader.jdbc(url, table, predicates=slices, properties=properties), schemas.SALES)


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor must reach.

    Without the setting it lies in the context's checkpoint folder; there is no other fallback.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage holds it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put a folder in the place of another one of the same storage."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"{path} could not be moved to {to}")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a step's output and continue from the files, with its types kept.

    Steps are normally joined by lineage alone; stage where several actions share an
    expensive step, or to cut a long lineage.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
