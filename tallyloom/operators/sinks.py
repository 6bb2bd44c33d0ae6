"""Writers. These are the only operators that run a job.

Replacing partitions is one commit per write but not atomic across partitions, so a target
must have one writer at a time. A rebuilt catalog table is switched at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from operator import and_
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import move, remove, scratch_dir, stage
from ..sources.targets import (
    NULL_PART,
    Target,
    exists,
    find_state,
    folders,
    stored_part_names,
    table_detail,
)
from .filters import require

_SETTING = RLock()


def _by_bucket(df: DataFrame, target: Target) -> DataFrame:
    """One task for each bucket, hence one file for each bucket of a partition."""
    return df.repartition(target.buckets, target.bucket_by)


def _arranged(df: DataFrame, target: Target) -> DataFrame:
    """The target's columns, gathered by partition value and sorted by key within a task.

    Without the gathering every task would write a file into every partition. The rebalance
    lets adaptive execution split a partition value that is too big for one task and join
    small ones, which a plain repartition by a few dates or months would not. The writer
    sorts by partition value anyway; sorted by key as well, the key column packs tightly,
    and a refresh reads it for the whole history.
    """
    part = F.col(target.partition_by)
    rest = [k for k in target.keys if k != target.partition_by]
    rows = df.select(*target.stored_columns)
    gathered = _by_bucket(rows, target) if target.buckets else rows.hint("rebalance", part)
    return gathered.sortWithinPartitions(part, *rest)


def _in_table_order(df: DataFrame, target: Target) -> DataFrame:
    """Inserts go by position, and an existing table may order its columns otherwise."""
    return df.select(*df.sparkSession.table(target.location).columns)


def _require_buckets(spark: SparkSession, target: Target) -> None:
    if not target.is_path and table_detail(spark, target).buckets != target.buckets:
        raise ValueError(f"{target.location} has other buckets than its target says")


def _create(df: DataFrame, target: Target, name: str, folder: str | None = None) -> None:
    """A new catalog table, whose partitions Spark finds in its folder, so that it can be switched."""
    writer = _arranged(df, target).write.partitionBy(target.partition_by).format("parquet")
    if target.buckets:
        writer = writer.bucketBy(target.buckets, target.bucket_by).sortBy(target.bucket_by)
    if folder is not None:
        writer = writer.option("path", folder)
    with _settings(df.sparkSession, {"spark.sql.hive.manageFilesourcePartitions": "false"}):
        writer.saveAsTable(name)


def append(df: DataFrame, target: Target) -> None:
    """Add the rows. Nothing is compared with the stored rows: a second run doubles them."""
    spark = df.sparkSession
    if target.is_path:
        writer = _arranged(df, target).write.mode("append")
        writer.partitionBy(target.partition_by).parquet(target.location)
    elif exists(spark, target):
        _require_buckets(spark, target)
        _in_table_order(_arranged(df, target), target).write.insertInto(target.location)
    else:
        _create(df, target, target.location)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """For catalog tables Spark takes these from the session, not from the writer.

    Writers of this module take turns. Other code that writes such tables meanwhile
    needs a session of its own.
    """
    with _SETTING:
        before = {key: spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)


def _replace_partitions(df: DataFrame, target: Target, arranged: bool = False) -> None:
    """Put the rows in the place of the partitions they fall into."""
    rows = df if arranged else _arranged(df, target)
    if target.is_path:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(target.partition_by).parquet(target.location)
    else:
        settings = {
            "spark.sql.sources.partitionOverwriteMode": "dynamic",
            # Buckets by customer serve a join by customer and date.
            "spark.sql.requireAllClusterKeysForCoPartition": "false",
        }
        with _settings(df.sparkSession, settings):
            _in_table_order(rows, target).write.insertInto(target.location, overwrite=True)


def replace_partitions(df: DataFrame, target: Target) -> None:
    """Put the rows in the place of the partitions they fall into, in one write."""
    if exists(df.sparkSession, target):
        _replace_partitions(df, target)
    else:
        append(df, target)


def drop_partition(spark: SparkSession, target: Target, value: str) -> None:
    """``value`` as in the partition's name."""
    name = target.partition_by
    if not target.is_path:
        detail = table_detail(spark, target)
        if detail.lists_partitions:
            given = "null" if value in ("null", NULL_PART) else f"'{value}'"
            spark.sql(f"ALTER TABLE {target.location} DROP IF EXISTS PARTITION ({name} = {given})")
            return
    folder = target.location if target.is_path else detail.folder
    remove(spark, f"{folder.rstrip('/')}/{name}={value}")
    if not target.is_path:
        spark.catalog.refreshTable(target.location)


def materialize(df: DataFrame, target: Target) -> None:
    """Replace the whole target, also partitions that the new rows do not touch.

    The rows are written once, into a folder of their own; a job that fails up to there leaves the stored
    rows as they were. A catalog table then changes its location to that folder: readers see all old
    rows or all new ones. What it held before stays until the next rebuild, for those who are reading it.

    At a path there is no such switch: the new partitions are moved over the stored ones, and then
    partitions without new rows go. So it is with a table whose partitions the catalog lists one by one,
    made elsewhere; its rows are staged and written again.
    """
    spark = df.sparkSession
    if find_state(spark, target) is None:
        append(df, target)
    elif target.is_path:
        _publish(df, target)
    elif table_detail(spark, target).lists_partitions:
        _overwrite(df, target)
    else:
        _require_buckets(spark, target)
        _switch(df, target)


def _versions(folder: str) -> tuple[str, str]:
    """A table's first folder, and the one beside it that holds what its rebuilds wrote."""
    parent = folder.rstrip("/").rsplit("/", 1)[0]
    first = parent.removesuffix("-versions") if parent.endswith("-versions") else folder.rstrip("/")
    return first, f"{first}-versions"


def _switch(df: DataFrame, target: Target) -> None:
    spark = df.sparkSession
    old = table_detail(spark, target).folder.rstrip("/")
    first, versions = _versions(old)
    new = f"{versions}/{uuid.uuid4().hex}"
    try:
        if target.buckets:  # Spark writes buckets for tables only
            helper = f"{target.location.rstrip('`')}_{uuid.uuid4().hex}"
            helper += "`" if target.location.endswith("`") else ""
            _create(df, target, helper, new)
            spark.sql(f"DROP TABLE {helper}")
        else:
            _arranged(df, target).write.partitionBy(target.partition_by).parquet(new)
        spark.sql(f"ALTER TABLE {target.location} SET LOCATION '{new}'")
    except BaseException:
        remove(spark, new)
        raise
    kept = {old, new}
    for folder in [first, *(f"{versions}/{x}" for x in folders(spark, versions))]:
        if not any(x.endswith(folder.split(":", 1)[-1]) for x in kept):
            remove(spark, folder)


def drop_target(spark: SparkSession, target: Target) -> None:
    """Remove a target and all that its rebuilds left."""
    if target.is_path:
        remove(spark, target.location)
    elif exists(spark, target):
        detail = table_detail(spark, target)
        first, versions = _versions(detail.folder)
        spark.sql(f"DROP TABLE {target.location}")
        remove(spark, first)
        remove(spark, versions)


def _publish(df: DataFrame, target: Target) -> None:
    spark = df.sparkSession
    base = target.location.rstrip("/")
    fresh = f"{base}/_rebuild-{uuid.uuid4().hex}"  # readers pass over such names
    begin = f"{target.partition_by}="
    try:
        _arranged(df, target).write.partitionBy(target.partition_by).parquet(fresh)
        names = {x for x in folders(spark, fresh) if x.startswith(begin)}
        stored = stored_part_names(spark, target)
        for name in sorted(names):
            move(spark, f"{fresh}/{name}", f"{base}/{name}")
        for value in stored - {x.removeprefix(begin) for x in names}:
            drop_partition(spark, target, value)
    finally:
        remove(spark, fresh)


def _overwrite(df: DataFrame, target: Target) -> None:
    spark = df.sparkSession
    path = scratch_dir(spark)
    try:
        rows = stage(df.select(*target.columns), path)
        stored = stored_part_names(spark, target)
        found = rows.select(target.partition_by).distinct().collect()  # dates or months
        if found:
            _replace_partitions(rows, target)
        for value in stored - {"null" if r[0] is None else str(r[0]) for r in found} - {
            NULL_PART for r in found if r[0] is None
        }:
            drop_partition(spark, target, value)
    finally:
        remove(spark, path)


def _require_unique(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows, or a failed job. Repeats of a key are counted where they are, before the shuffle."""
    values = [F.first(c).alias(c) for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(*values, F.count(F.lit(1)).alias("_n"))
    message = f"two rows for one key ({', '.join(keys)})"
    return require(counted, F.col("_n") == 1, message).select(*df.columns)


def _touched(df: DataFrame, target: Target) -> Column:
    """Predicate for the partitions the rows fall into; there are as many as dates or months."""
    part = F.col(target.partition_by)
    values = [r[0] for r in df.select(part).distinct().collect()]
    known = [v for v in values if v is not None]
    return part.isin(known) | part.isNull() if None in values else part.isin(known)


def merge(stored: DataFrame, batch: DataFrame, target: Target) -> DataFrame:
    """Stored rows with the batch put over them.

    One full join, in which each side is computed once. An anti-join and a union would
    compute the batch twice, as the two uses need different columns.
    """
    if target.buckets and target.null_keys:
        # Buckets serve a plain equality; the few rows with a null key meet apart.
        known = reduce(and_, [F.col(k).isNotNull() for k in target.keys])
        plain = replace(target, null_keys=False)
        rest = replace(target, buckets=None)
        return merge(stored.where(known), batch.where(known), plain).unionByName(
            merge(stored.where(~known), batch.where(~known), rest)
        )
    s = stored.alias("s")
    b = batch.select(*target.columns, F.lit(True).alias("_given")).alias("b")
    pairs = [(F.col(f"s.{k}"), F.col(f"b.{k}")) for k in target.keys]
    # Plain equality keeps the partitioning of a batch that was grouped by its key.
    same = [x.eqNullSafe(y) if target.null_keys else x == y for x, y in pairs]
    given = F.col("b._given")
    return s.join(b, reduce(and_, same), "full").select(
        *[F.when(given, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in target.columns]
    )


def upsert(
    df: DataFrame,
    target: Target,
    touching: Column | None = None,
    unique: bool = False,
    stored: DataFrame | None = None,
) -> None:
    """Insert rows with new keys, replace rows with known keys, keep all others.

    Only the touched partitions are read and rewritten. ``touching`` names them as a
    predicate on the partition column; without it the batch is staged first, to find them
    without computing it twice. ``unique=True`` states that the batch has one row per key by
    construction; otherwise a repeated key fails the job. A null key fails it where the
    target has none. ``stored`` is the target's present state where the caller has it open.
    """
    batch = df if unique else _require_unique(df, target.keys)
    if not target.null_keys:
        known = reduce(and_, [F.col(k).isNotNull() for k in target.keys])
        batch = require(batch, known, f"a key column is null ({', '.join(target.keys)})")
    if stored is None:
        stored = find_state(df.sparkSession, target)
    if stored is None:
        append(batch, target)
        return
    _require_buckets(df.sparkSession, target)
    staged = None
    try:
        # Rows with and without null keys are two uses of the batch where there are buckets.
        if touching is None or (target.buckets and target.null_keys):
            staged = scratch_dir(df.sparkSession)
            batch = stage(batch, staged)
            touching = _touched(batch, target) if touching is None else touching
        # A row outside would replace a partition whose stored rows were not read.
        batch = require(batch, touching, "a row lies outside the partitions named as touched")
        merged = merge(stored.where(touching), batch, target)
        # A join by buckets leaves each in a task of its own, as the writer wants them.
        _replace_partitions(merged, target, arranged=bool(target.buckets))
    finally:
        if staged is not None:
            remove(df.sparkSession, staged)
