"""The folder that driver and executors share, and words as all operators cut them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``. Spark's writers make it.

    Where that setting is absent, as in tests on one machine, a temporary folder takes its place;
    a session that runs on several machines is refused.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="checkpoints-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint: computed once, and lost executors don't lose them.

    Spark's cleaner removes the files when nothing refers to them any more, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_folder(df.sparkSession, "checked")
    return df.checkpoint(eager=True)


@contextmanager
def steady_splits(spark: SparkSession) -> Iterator[None]:
    """Within it a file source is cut into the same portions each time it is read.

    Otherwise Spark derives them from the cores it has at the moment, and a lost executor changes
    which partition a row is in.
    """
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)


def words(text: Column) -> Column:
    """The words of a text; none for null and for white space only."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) > 0, F.split(trimmed, GAP)).otherwise(
        F.array().cast("array<string>")
    )


def n_words(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast(
        "long"
    )


def free_prefix(columns: list[str], begin: str = "__") -> str:
    """A beginning that no column's name has; names are the same in either case."""
    while any(c.lower().startswith(begin.lower()) for c in columns):
        begin = "_" + begin
    return begin
