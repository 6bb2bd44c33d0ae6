"""The tables the jobs maintain."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

#: Name that the null partition has in paths.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Target:
    """A Parquet table, in the catalog or at a path (a location with a slash).

    ``null_keys`` states that key columns may be null, and that nulls are equal to each other.
    ``lookback`` says what the earlier values of a KPI table mean, ``retention_rule`` what counts as
    Retained. ``buckets`` makes a new catalog table
    bucketed and sorted by the key besides the partition column: an upsert then joins the stored rows where
    they lie, and a read of one customer opens one bucket.
    """

    location: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: str
    null_keys: bool = False
    lookback: str | None = None
    buckets: int | None = None
    retention_rule: str = "numbers"

    def __post_init__(self):
        if self.buckets is not None and (self.is_path or self.buckets < 1):
            raise ValueError("only a catalog table can have buckets, one at least")

    @property
    def is_path(self) -> bool:
        return "/" in self.location

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def stored_columns(self) -> list[str]:
        """Column order of the files: the partition column comes last."""
        return [c for c in self.columns if c != self.partition_by] + [self.partition_by]


    @property
    def bucket_by(self) -> str:
        return next(k for k in self.keys if k != self.partition_by)


def daily_target(location: str, buckets: int | None = None) -> Target:
    keys = ("customer_id", "date")
    return Target(location, schemas.DAILY_STATS, keys, "date", buckets=buckets)


def kpi_target(
    location: str,
    lookback: str = "calendar",
    buckets: int | None = None,
    retention_rule: str = "numbers",
) -> Target:
    schema = {"calendar": schemas.KPI_CALENDAR, "active": schemas.KPI_ACTIVE}[lookback]
    keys = ("customer_id", "order_month")
    return Target(
        location,
        schema,
        keys,
        "order_month",
        null_keys=True,
        lookback=lookback,
        buckets=buckets,
        retention_rule=retention_rule,
    )


def last_active_target(location: str) -> Target:
    """Each customer's last active month before a moment; a partition for each such moment."""
    keys = ("customer_id", "before")
    return Target(location, schemas.LAST_ACTIVE, keys, "before", null_keys=True)


def digests_target(location: str) -> Target:
    """A digest of each month of the source."""
    return Target(location, schemas.MONTH_DIGESTS, ("order_month", "year"), "year")


def ledger_target(location: str) -> Target:
    """Run dates that were computed, also those without rows."""
    return Target(location, schemas.RUN_LEDGER, ("date", "month"), "month")


def find_state(spark: SparkSession, target: Target) -> DataFrame | None:
    """What the target holds now; None before the first run.

    Opening a path lists its files. A job that needs the state more than once should open it
    once and pass it on.
    """
    if not target.is_path:
        if not spark.catalog.tableExists(target.location):
            return None
        return spark.table(target.location).select(*target.columns)
    try:
        df = spark.read.schema(target.schema).parquet(target.location)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return df.select(*target.columns)


def stored_columns_of(spark: SparkSession, target: Target) -> set[str] | None:
    """Columns of what is stored; None where there is nothing."""
    if not target.is_path:
        there = spark.catalog.tableExists(target.location)
        return set(spark.table(target.location).columns) if there else None
    try:
        return set(spark.read.parquet(target.location).columns)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def require_same_table(spark: SparkSession, target: Target) -> None:
    """Fail if what is stored has other columns than the target, such as another lookback."""
    if stored_columns_of(spark, target) not in (None, set(target.columns)):
        raise ValueError(f"{target.location} holds a table with other columns")


@dataclass(frozen=True)
class TableDetail:
    """What the catalog says of a table's files."""

    folder: str
    lists_partitions: bool  # in the catalog, each with a folder of its own
    buckets: int | None


def table_detail(spark: SparkSession, target: Target) -> TableDetail:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target.location}").collect()
    names = [r.col_name for r in rows]
    about = {r.col_name: r.data_type for r in rows[names.index("# Detailed Table Information") :]}
    buckets = about.get("Num Buckets")
    return TableDetail(
        about["Location"], about.get("Partition Provider") == "Catalog", int(buckets) if buckets else None
    )


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []


def stored_part_names(spark: SparkSession, target: Target) -> set[str]:
    """The values in the names of the target's partitions; opens no file."""
    if target.is_path:
        names = folders(spark, target.location)
    elif not spark.catalog.tableExists(target.location):
        names = []
    elif (detail := table_detail(spark, target)).lists_partitions:
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {target.location}").collect()]
    else:
        names = folders(spark, detail.folder)
    begin = f"{target.partition_by}="
    return {x.removeprefix(begin) for x in names if x.startswith(begin)}


def stored_parts(spark: SparkSession, target: Target) -> list[dt.date]:
    """Dates or months that the target has a partition of, the latest first; opens no file.

    The null partition is left out, and a partition need not hold rows.
    """
    names = stored_part_names(spark, target) - {"null", NULL_PART}
    return sorted(map(dt.date.fromisoformat, names), reverse=True)


def exists(spark: SparkSession, target: Target) -> bool:
    return find_state(spark, target) is not None


def empty_state(spark: SparkSession, target: Target) -> DataFrame:
    """No rows. Folds to an empty local relation, so joins and unions with it fold away."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def read_state(spark: SparkSession, target: Target) -> DataFrame:
    """What the target holds now; an empty frame of its schema before the first run."""
    found = find_state(spark, target)
    return empty_state(spark, target) if found is None else found
