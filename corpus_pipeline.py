"""A training-data pipeline over ``documents``: each stage calls one operator of ``tallyloom.llm``.

1. ``quality``: documents that the quality rules reject go.
2. ``near_duplicates``: of each SimHash component one document stays.
3. ``secrets``: secrets are replaced in the text; documents stay.
4. ``mixing``: documents are taken as often as the mix of sources needs them.
5. ``tokens``: texts become token ids, with the digest of what the ids decode to.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
before the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, mixing, quality, secrets, simhash
from tallyloom.llm.queries import NEAR, tokenizer
from tallyloom.llm.shared import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, **NEAR)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.trained(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer(spark), [F.col("doc_id"), F.col("source")])


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("secrets", replace_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: Fingerprints, a fitted model and token ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
