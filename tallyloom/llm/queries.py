"""Registered queries of the training-data operators, each over its whole table, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    crf,
    huffman,
    mixing,
    negatives,
    quality,
    secrets,
    shards,
    simhash,
    tokenfiles,
    topk,
    vectorcodes,
    warc,
)
from .shared import kept, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

RANKS = "byte_bpe_50k.tiktoken"
#: Free in the vocabulary: ends a document in a token file.
END = 50256
#: The tokenizer of the coded token files, and the id that follows each document there.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
N_SHARDS = 40
NEAR = {"shingle": 3, "max_bits": 3}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record, and what the records restored from the archive say."""
    path = shared_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.summary(warc.read(spark, path))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.link(_table(spark, sf_dir, "documents"), **NEAR).select(
        "doc_id", simhash.hex16(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return crf.extract(_table(spark, sf_dir, "pages"), crf.trained())


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode(docs, tokenizer(spark), [F.col("doc_id")]).drop("ids")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # The measures are taken once, for the model and the verdicts.
    measured = kept(quality.measure(docs).drop("text"))
    return quality.judged(measured, quality.fit(measured)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and shard in a larger tree of every document."""
    tree = shards.grid(N_SHARDS)
    return shards.assign(_table(spark, sf_dir, "documents"), tree, shards.grown(tree))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, secrets and the redacted text's digest of every document."""
    return secrets.scan(_table(spark, sf_dir, "documents"), secrets.trained(spark))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, found by scanning flat token files."""
    return tokenfiles.count_documents(
        _table(spark, sf_dir, "documents"),
        tokenizer(spark),
        shared_folder(spark, "tokens"),
        END,
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best negatives for each of the five positives of every fiftieth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    coded, books = vectorcodes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def op13_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from files of Huffman codes."""
    path = shared_folder(spark, "huffman")
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        huffman.write(_table(spark, sf_dir, "documents"), path, f.read(), END_ID)
    return huffman.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc, op2_simhash, op3_mixing, op4_html, op5_bpe, op6_quality, op7_sharding,
        op8_secrets, op9_topk, op10_tokens, op11_negatives,
        op12_codes, op13_huffman,
    )
}

#: Base32 of the hexadecimal digest h: each 5 of its digits make 4 characters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {5 * (k // 4) + 1}, 5) "
    f"AS BIGINT) >> {15 - 5 * (k % 4)}) & 31 AS INTEGER) + 1, 1)"
    for k in range(32)
)

def _assigned(books: str) -> str:
    """Each part's nearest entry and its distance, as distance * 64 + entry."""
    return f"""(
        SELECT vec_id, part, min(distance * 64 + entry) AS best FROM (
            SELECT p.vec_id, p.part, c.entry, CAST(sum((p.v - c.v) * (p.v - c.v)) AS BIGINT) AS distance
            FROM p JOIN {books} c ON p.part = c.part AND p.pos = c.pos
            GROUP BY p.vec_id, p.part, c.entry
        ) GROUP BY vec_id, part
    )"""


def _means(books: str, assigned: str) -> str:
    """The entries replaced by the floor of their parts' mean."""
    return f"""(
        SELECT c.part, c.entry, c.pos, coalesce(m.v, c.v) AS v
        FROM {books} c LEFT JOIN (
            SELECT a.part, a.best % 64 AS entry, p.pos, CAST(floor(sum(p.v) / count(*)) AS BIGINT) AS v
            FROM {assigned} a JOIN p ON a.vec_id = p.vec_id AND a.part = p.part
            GROUP BY a.part, a.best % 64, p.pos
        ) m ON c.part = m.part AND c.entry = m.entry AND c.pos = m.pos
    )"""


ORACLE: dict[str, str] = {
    "op1_warc": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
        ), d AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS kept FROM p
        )
        SELECT page_id,
            CAST(strlen(html) AS BIGINT) AS payload_bytes,
            {_BASE32} AS payload_digest,
            CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> kept THEN kept END AS refers_to
        FROM d
    """,
    "op9_topk": """
        WITH u AS (
            SELECT vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS x
            FROM embeddings WHERE embedding IS NOT NULL
        ), w AS (
            SELECT vec_id, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v
            FROM u
            WHERE vec_id NOT IN (SELECT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x))
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
            FROM w q JOIN w c ON q.d = c.d AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
            GROUP BY q.vec_id, c.vec_id
        ), r AS (
            SELECT query_id, vec_id, score,
                row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_negatives": """
        WITH e AS (
            SELECT vec_id, embedding,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        ), u AS (
            SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS x FROM e
        ), w AS (
            SELECT vec_id, label, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v
            FROM u
            WHERE vec_id NOT IN (SELECT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x))
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
                CAST(sum(a.v * c.v) AS BIGINT) AS score
            FROM w a JOIN w c ON a.d = c.d AND a.vec_id <> c.vec_id
            WHERE a.vec_id % 50 = 0
            GROUP BY a.vec_id, c.vec_id, a.label = c.label
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
            FROM s WHERE same
        ), r AS (
            SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score,
                score AS negative_score, row_number() OVER (
                    PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id
                ) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
                AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
            WHERE nth <= 5
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
            negative_score
        FROM r WHERE rank <= 3
    """,
    "op12_codes": f"""
        WITH u AS (
            SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS d, unnest(embedding) AS x,
                len(embedding) // 16 AS width
            FROM embeddings WHERE embedding IS NOT NULL
        ), p AS MATERIALIZED (
            SELECT vec_id, d // width AS part, d % width AS pos,
                CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v
            FROM u
            WHERE vec_id NOT IN (SELECT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x))
        ), first AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry
            FROM (SELECT DISTINCT vec_id FROM p) ORDER BY vec_id LIMIT 64
        ), c0 AS MATERIALIZED (SELECT part, entry, pos, v FROM p JOIN first USING (vec_id)),
        a0 AS MATERIALIZED {_assigned("c0")}, c1 AS MATERIALIZED {_means("c0", "a0")},
        a1 AS MATERIALIZED {_assigned("c1")}, c2 AS MATERIALIZED {_means("c1", "a1")},
        a2 AS MATERIALIZED {_assigned("c2")},
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
                CAST(sum(best // 64) AS BIGINT) AS error
            FROM a2 GROUP BY vec_id
        )
        SELECT vec_id, code, error,
            CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c2)
                AS codebooks_sha256
        FROM coded JOIN embeddings USING (vec_id)
    """,
}
