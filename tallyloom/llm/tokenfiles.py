"""Token counts by a separator scan of flat token files.

A flat token file holds nothing but token ids of a fixed width; an end-of-document id follows each
document. There is no index: where documents end is only seen by looking at the ids.

* **Writing.** Spark's text writer writes a row's bytes as they are and a line separator after each
  row; the separator is the end-of-document id's bytes. So files go to any storage that Spark
  writes to. A file is full once it has ``FILE_BYTES``, so it holds less than that and one document;
  the files of a part lie in folders ``piece=PPPPPP-NNNNN``.
* **Scan.** A file is cut into blocks of ``BLOCK_TOKENS`` ids without regard to documents. In a
  block all separators are found with one comparison over the array; what lies
  before the first and after the last one belongs to documents that go beyond the block. Files of one
  part are scanned by different tasks.
* **Stitching.** Running sums over the blocks of a part (ids so far, separators so far) and a running
  maximum (where the last separator was) give each block the place and length of the
  document that it continues.
* **Documents' ids.** The writer also notes which document was the nth of which part, and its length
  in bytes. A scan that finds other numbers of documents fails.

Edge cases: a null or empty text is a document of no tokens, which two separators in a row
show; ids after the last separator are a document that was not ended; an empty file has no documents;
repeated rows are documents of their own; other columns may have any name. Ids that the file's type cannot
hold, and a separator that is a token, are refused. Files made elsewhere may have up to 2 GiB, which is what
Spark reads as one value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import Tokenizer, in_portions
from .shared import kept, steady_splits

FILE_BYTES = 64 << 20
BLOCK_TOKENS = 1 << 16
PIECE = r"^piece=\d+-\d+$"
#: Bits of monotonically_increasing_id() that number the rows of a partition.
ROW_BITS = 33


def write(
    docs: DataFrame,
    tokenizer: Tokenizer,
    path: str,
    end: int,
    dtype: str = "<u2",
    text: str = "text",
) -> None:
    """Flat token files of all texts, partition by partition, in the order of the rows."""
    rows = docs.select(F.col(text).alias("text"))
    tokens = tokenizer.sent.value.values()
    if max(*tokens, end) > np.iinfo(dtype).max:
        raise ValueError(f"ids up to {max(*tokens, end)} don't fit the type {dtype}")
    if end in set(tokens):
        raise ValueError(f"the separator {end} is a token")
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder(dtype)
        part, piece, held, nth = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for texts in in_portions(batch.column(0)):
                ids, pieces = encoder.encode_all(texts), []
                for x in ids:
                    if held >= FILE_BYTES:
                        piece, held = piece + 1, 0
                    pieces.append(f"{part:06d}-{piece:05d}")
                    held += len(x) + width
                places = pa.array(range(nth, nth + len(ids)), pa.int64())
                nth += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(pieces), places], ["ids", "piece", "nth"]
                )

    separator = np.array([end], dtype).tobytes().decode("latin-1")
    (
        rows.mapInArrow(run, "ids binary, piece string, nth long")
        .sortWithinPartitions("piece", "nth")  # the writer takes rows sorted by folder as they come
        .select(F.col("ids").cast("string"), "piece")
        .write.partitionBy("piece")
        .option("lineSep", separator)
        .option("encoding", "ISO-8859-1")
        .text(path)
    )


def manifest(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, nth, doc_id, n_bytes): which document is the nth of which part."""
    place = F.monotonically_increasing_id()
    return docs.select(
        F.shiftright(place, ROW_BITS).alias("part"),
        place.bitwiseAND((1 << ROW_BITS) - 1).alias("nth"),
        F.col(id).alias("doc_id"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
    )


def scan_block(ids: np.ndarray, end: int) -> tuple[int, int, list[int]]:
    """Ids before the first separator, after the last, and counts of documents between."""
    at = np.flatnonzero(ids == end)
    if not len(at):
        return len(ids), len(ids), []
    return int(at[0]), len(ids) - int(at[-1]) - 1, (np.diff(at) - 1).tolist()


def blocks(
    spark: SparkSession, path: str, end: int, dtype: str = "<u2", block: int = BLOCK_TOKENS
) -> DataFrame:
    """A row for each block of each file: its place, separators and counts."""
    folder, name = (F.element_at(F.split("path", "/"), i) for i in (-2, -1))
    in_piece = folder.rlike(PIECE)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.when(in_piece, F.concat_ws("/", folder, name)).otherwise(name).alias("file"), "content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), dtype)
                found = [scan_block(ids[a : a + block], end) for a in range(0, len(ids), block)]
                ends = [np.count_nonzero(ids[a : a + block] == end) for a in range(0, len(ids), block)]
                sizes = [min(block, len(ids) - a) for a in range(0, len(ids), block)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.as_py()] * len(found), pa.string()),
                        pa.array(range(len(found)), pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(ends, pa.int64()),
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([x[1] for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "n", "ends", "head", "tail", "inner"],
                )

    return files.mapInArrow(
        run,
        "file string, block long, n long, ends long, head long, tail long, inner array<long>",
    )


def counts(
    spark: SparkSession, path: str, end: int, dtype: str = "<u2", block: int = BLOCK_TOKENS
) -> DataFrame:
    """(part, nth, n_tokens) of each document in the files of a folder.

    Files in folders named piece=NNNNNN-..., and others named part-NNNNN..., belong to part NNNNN and follow
    each other in the order of their names; any other file is a part named by itself and keeps
    ``part`` null.
    """
    part = F.regexp_extract("file", r"^(?:piece=|part-)(\d+)-", 1)
    rows = blocks(spark, path, end, dtype, block).withColumn(
        "name", F.when(part != "", part).otherwise(F.col("file"))
    )
    order = Window.partitionBy("name").orderBy("file", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select(
        "name",
        "file",
        "block",
        "n",
        "ends",
        "head",
        "tail",
        "inner",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"),
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("first"),
        F.lead("file").over(order).isNull().alias("is_last"),
    ).withColumn("after", F.when(F.col("ends") > 0, F.col("begin") + F.col("n") - F.col("tail")))
    # ids between the last separator so far and this block
    carried = F.col("begin") - F.coalesce(F.max("after").over(before), F.lit(0))
    placed = placed.withColumn("carried", carried)
    ended = F.when(
        F.col("ends") > 0,
        F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner")),
    ).otherwise(F.array().cast("array<bigint>"))
    open_ids = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("n"))
    unended = F.when(F.col("is_last") & (open_ids > 0), F.array(open_ids)).otherwise(
        F.array().cast("array<bigint>")
    )
    return placed.select(
        "name", "first", F.posexplode(F.concat(ended, unended)).alias("k", "n_tokens")
    ).select(
        F.when(F.col("name").rlike(r"^\d+$"), F.col("name")).cast("long").alias("part"),
        (F.col("first") + F.col("k")).alias("nth"),
        "n_tokens",
    )


def count_documents(
    docs: DataFrame,
    tokenizer: Tokenizer,
    path: str,
    end: int,
    dtype: str = "<u2",
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, n_bytes): writes the texts' token files to ``path`` and counts by scan.

    ``docs`` must give its rows in the same order each time it is read, as files do.
    """
    with steady_splits(docs.sparkSession):
        noted = kept(manifest(docs, id, text))
        write(docs, tokenizer, path, end, dtype, text)
    found = counts(docs.sparkSession, path, end, dtype)
    wrong = F.raise_error(F.lit("token files and documents don't match"))
    matched = F.col("n_tokens").isNotNull() & F.col("n_bytes").isNotNull()
    return noted.join(found, ["part", "nth"], "full").select(
        F.when(matched, F.col("doc_id")).otherwise(wrong.cast("long")).alias("doc_id"),
        "n_tokens",
        "n_bytes",
    )
