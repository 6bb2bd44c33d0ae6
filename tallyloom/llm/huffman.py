"""Token files in a canonical Huffman code of limited length.

* **Encoding.** Documents are put into ascending order of their ids by one range shuffle and encoded in that
  order (``pieces``); an end id follows each. Chunks of whole documents, about ``CHUNK`` ids, are
  staged once, as the code needs counts of all ids first.
* **Code.** Counts of ids are summed over all tasks: one row for each id of the vocabulary, whatever the
  size of the corpus. The driver turns them into code lengths of at most ``LONGEST`` bits by
  package-merge, which is the best code under that limit. Codes are canonical, so the lengths say all.
* **Files.** A folder ``code`` holds the lengths. Each folder ``chunks/piece=RRRRRR-NNNN`` holds the chunks
  of a stretch of documents, up to ``FILE_CHUNKS`` of them; folders, and chunks in a file, ascend. All whole
  numbers are little-endian. A chunk is

  - ``MAGIC``; numbers of documents (8 bytes) and of ids (8), place of its first id among all ids (8),
    ids in a block (4), bytes of codes (8), CRC-32 of all that follows (4);
  - for each document its id (8), for each whether the id is there (1), for each its ids (8);
  - for each block of ids the bit at which it begins (8): the checkpoints;
  - the codes, each from its highest bit, in bytes from the highest bit.

  A line end follows each chunk, as Spark's text writer puts it there.
* **Decoding.** Blocks are independent. A table of 2 ** (longest code) entries says which id and how many
  bits any next bits stand for. All blocks of a chunk are decoded together, one id of each at a
  time; each must end where the next begins.

Edge cases: a null or empty text has the end id alone; null ids come last; of equal ids the texts are ordered by
a hash; repeated rows are documents; a single distinct id gets one bit; an empty table gives files without
chunks; the end id may also occur within documents, as nothing but the counts says where they end.
Document ids are whole numbers. Other columns may have any name.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import remove
from .bpe import in_portions
from .pieces import pieces_of
from .shared import shared_folder

LONGEST = 18
CHUNK = 1 << 18
BLOCK = 256
FILE_CHUNKS = 128
#: Characters that are encoded together.
PORTION = 4 << 20
MAGIC = b"TLH1"
HEAD = struct.Struct("<4sQQQIQI")
CODE_HEAD = struct.Struct("<4sIIB")


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each id's code, 0 for ids that don't occur: the best code of at most ``longest`` bits.

    Package-merge: items of a level are the ids and pairs of the level below, by weight. The lightest
    2n - 2 items of the last level are chosen; an id gets a bit for each level it is chosen at.
    """
    used = np.flatnonzero(counts)
    n = len(used)
    lengths = np.zeros(len(counts), np.uint8)
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    if n < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    level, is_id = weights, [np.ones(n, bool)]
    for _ in range(longest - 1):
        even = len(level) // 2 * 2
        pairs = level[0:even:2] + level[1:even:2]
        both = np.concatenate([weights, pairs])
        by_weight = np.argsort(both, kind="stable")
        level = both[by_weight]
        is_id.append(by_weight < n)
    chosen = 2 * n - 2
    for ids in reversed(is_id):
        taken = int(ids[:chosen].sum())
        lengths[order[:taken]] += 1
        chosen = 2 * (chosen - taken)
    return lengths


class Code:
    """Canonical codes: by length, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        self.longest = int(self.lengths.max(initial=0))
        size = 1 << (self.longest - self.lengths[order])
        first = np.cumsum(size) - size
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = first >> (self.longest - self.lengths[order])
        if size.sum() > 1 << self.longest:
            raise ValueError("these lengths are no prefix code")
        # Id and bits for any next bits; no bits where no code begins so.
        self.table = np.zeros(1 << self.longest, np.uint32)
        self.table[: size.sum()] = np.repeat(order << 8 | self.lengths[order], size)

    def pack(self, ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
        """The codes of the ids in bytes, and the bit at which each block begins."""
        bits = self.lengths[ids]
        if not bits.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(bits)
        begin = ends - bits
        # Each code lies within the 64 bits from the 32-bit word in which it begins.
        word = begin >> 5
        value = self.codes[ids] << (64 - (begin & 31) - bits).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        wide = np.add.reduceat(value, first)
        out = np.zeros(len(wide) + 1, np.uint64)
        out[:-1] = wide >> np.uint64(32)
        out[1:] += wide & np.uint64(0xFFFFFFFF)
        n_bytes = -(-int(ends[-1]) // 8)
        return out.astype(">u4").tobytes()[:n_bytes], begin[::block]

    def unpack(self, data: bytes, n: int, begin: np.ndarray, block: int) -> np.ndarray:
        """The n ids of blocks that begin at the given bits."""
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = begin.astype(np.int64)
        out = np.zeros((block, len(at)), np.uint32)
        last = n - (len(at) - 1) * block  # ids of the last block
        for i in range(block):
            if i == last:
                final, at = at[-1:], at[:-1]
            next_bits = ahead[at >> 3] << (at & 7).astype(np.uint32) >> np.uint32(32 - self.longest)
            found = self.table[next_bits]
            out[i, : len(at)] = found >> 8
            at = at + (found & 255)
        if last < block:
            at = np.append(at, final)
        if (at[:-1] != begin[1:]).any() or -(-int(at[-1]) // 8) != len(data):
            raise ValueError("a block doesn't end where the next begins")
        return out.T.reshape(-1)[:n]


@dataclass(frozen=True)
class Chunk:
    """Whole documents that follow each other."""

    doc_ids: pa.Array
    n_tokens: np.ndarray
    start: int
    ids: np.ndarray

    def to_bytes(self, code: Code, block: int = BLOCK) -> bytes:
        data, begin = code.pack(self.ids, block)
        given = self.doc_ids.is_valid().to_numpy(zero_copy_only=False)
        body = b"".join(
            [
                self.doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                given.astype(np.uint8).tobytes(),
                self.n_tokens.astype("<i8").tobytes(),
                begin.astype("<i8").tobytes(),
                data,
            ]
        )
        sizes = (len(self.n_tokens), len(self.ids), self.start, block, len(data), zlib.crc32(body))
        return HEAD.pack(MAGIC, *sizes) + body

    @staticmethod
    def all_of(file: bytes | memoryview, code: Code) -> Iterator[Chunk]:
        """The chunks of a file."""
        at = 0
        while at < len(file):
            magic, n_docs, n, start, block, n_bytes, crc = HEAD.unpack_from(file, at)
            if magic != MAGIC:
                raise ValueError("not a chunk of token codes")
            at += HEAD.size
            n_blocks = -(-n // block)
            end = at + 17 * n_docs + 8 * n_blocks + n_bytes
            body = file[at:end]
            if zlib.crc32(body) != crc:
                raise ValueError("a damaged chunk of token codes")
            at = end + 1  # the line end
            cut = np.cumsum([0, 8 * n_docs, n_docs, 8 * n_docs, 8 * n_blocks, n_bytes]).tolist()
            doc_ids, given, n_tokens, begin, data = (body[a:b] for a, b in zip(cut, cut[1:]))
            given = np.frombuffer(given, np.uint8) == 1
            yield Chunk(
                pa.array(np.frombuffer(doc_ids, "<i8"), mask=~given),
                np.frombuffer(n_tokens, "<i8"),
                start,
                code.unpack(bytes(data), n, np.frombuffer(begin, "<i8"), block),
            )


def _ordered(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text) in ranges of ids, sorted within each."""
    rows = docs.select(
        F.col(id).cast("long").alias("id"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("hash"),
        # Parts a row that is repeated very often; where it was read doesn't change its content.
        F.spark_partition_id().alias("source"),
    )
    order = [F.asc_nulls_last("id"), "hash", "source"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")


def _staged(docs: DataFrame, tokenizer: str, end: int, path: str, id: str, text: str) -> DataFrame:
    """Chunks of ids before they are coded: (part, chunk, n_ids, start, doc_ids, n_tokens, ids)."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(sent.value)
        part, chunk, begin = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            done = 0
            for texts in in_portions(batch.column(1), PORTION):
                doc_ids = batch.column(0).slice(done, len(texts))
                done += len(texts)
                ids, n = pieces.encode(texts)
                stop = np.cumsum(n)
                ids = np.insert(ids, stop, end).astype("<u4")
                n = n + 1
                stop = np.cumsum(n)
                # Documents that begin in the same CHUNK ids make a chunk.
                first = np.flatnonzero(np.diff((stop - n) // CHUNK, prepend=-1))
                for a, b in zip(first.tolist(), np.append(first[1:], len(n)).tolist()):
                    own = ids[stop[a] - n[a] : stop[b - 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part], pa.int64()),
                            pa.array([chunk], pa.int64()),
                            pa.array([len(own)], pa.int64()),
                            pa.array([begin], pa.int64()),
                            pa.ListArray.from_arrays([0, b - a], doc_ids.slice(a, b - a)),
                            pa.ListArray.from_arrays([0, b - a], pa.array(n[a:b])),
                            pa.array([own.astype(_narrow(own)).tobytes()], pa.binary()),
                        ],
                        ["part", "chunk", "n_ids", "start", "doc_ids", "n_tokens", "ids"],
                    )
                    chunk, begin = chunk + 1, begin + len(own)

    schema = (
        "part long, chunk long, n_ids long, start long, doc_ids array<long>, n_tokens array<long>, "
        "ids binary"
    )
    chunks = _ordered(docs, id, text).mapInArrow(run, schema)
    chunks.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _narrow(ids: np.ndarray) -> str:
    """Two bytes for each id where they do."""
    return "<u2" if ids.max(initial=0) < 1 << 16 else "<u4"


def _wide(data: pa.Scalar, n: int) -> np.ndarray:
    raw = data.as_buffer()
    return np.frombuffer(raw, "<u2" if raw.size == 2 * n else "<u4")


def counts(chunks: DataFrame) -> np.ndarray:
    """How often each id occurs; one row for each id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for n, data in zip(batch.column("n_ids").to_pylist(), batch.column("ids")):
                found = np.bincount(_wide(data, n), minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = chunks.select("n_ids", "ids").mapInArrow(run, "id long, n long")
    rows = found.groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 + max((r.id for r in rows), default=-1), np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def _save_bytes(rows: DataFrame, path: str) -> None:
    """Rows of one binary column ``bytes``, as they are, a line end after each."""
    parts = [c for c in rows.columns if c != "bytes"]
    rows.select(F.col("bytes").cast("string"), *parts).write.partitionBy(*parts).text(path)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end: int,
    longest: int = LONGEST,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Token files of all documents under ``path``. ``tokenizer`` is the JSON of the tokenizers library."""
    spark = docs.sparkSession
    staged = shared_folder(spark, "token-chunks")
    try:
        chunks = _staged(docs, tokenizer, end, staged, id, text)
        lengths = code_lengths(counts(chunks), longest)
        sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
        before, total = {}, 0
        for r in sizes:  # one row for each task that staged chunks
            before[r.part], total = total, total + r.n
        sent = spark.sparkContext.broadcast((lengths.tobytes(), before))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code, before = Code(np.frombuffer(sent.value[0], np.uint8)), sent.value[1]
            for batch in batches:
                for i, row in enumerate(batch.select(["part", "chunk", "n_ids", "start"]).to_pylist()):
                    chunk = Chunk(
                        batch.column("doc_ids")[i].values,
                        batch.column("n_tokens")[i].values.to_numpy(),
                        before[row["part"]] + row["start"],
                        _wide(batch.column("ids")[i], row["n_ids"]),
                    )
                    piece = f"{row['part']:06d}-{row['chunk'] // FILE_CHUNKS:04d}"
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([piece]), pa.array([row["chunk"]]), pa.array([chunk.to_bytes(code)])],
                        ["piece", "chunk", "bytes"],
                    )

        coded = chunks.mapInArrow(run, "piece string, chunk long, bytes binary")
        # The writer takes rows sorted by folder as they come.
        _save_bytes(coded.sortWithinPartitions("piece", "chunk").drop("chunk"), f"{path}/chunks")
    finally:
        remove(spark, staged)
    head = CODE_HEAD.pack(MAGIC, end, len(lengths), longest)
    code = spark.createDataFrame([(head + lengths.tobytes(),)], "bytes binary").coalesce(1)
    _save_bytes(code, f"{path}/code")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files in a folder; ids as 32-bit whole numbers."""
    files = spark.read.format("binaryFile")
    saved = max(bytes(r.content) for r in files.load(f"{path}/code").select("content").collect())
    magic, end, n, _ = CODE_HEAD.unpack_from(saved)
    if magic != MAGIC:
        raise ValueError("not a code of token files")
    sent = spark.sparkContext.broadcast(saved[CODE_HEAD.size : CODE_HEAD.size + n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(np.frombuffer(sent.value, np.uint8))
        for batch in batches:
            for file in batch.column(0):
                for chunk in Chunk.all_of(memoryview(file.as_buffer()), code):
                    stop = np.cumsum(chunk.n_tokens)
                    if (chunk.ids[stop - 1] != end).any():
                        raise ValueError("a document without its end")
                    first = stop - chunk.n_tokens
                    data = chunk.ids.astype("<u4").tobytes()
                    cut = zip((4 * first).tolist(), (4 * stop).tolist())
                    yield pa.RecordBatch.from_arrays(
                        [
                            chunk.doc_ids,
                            pa.array(chunk.start + first),
                            pa.array(chunk.n_tokens),
                            pa.array([data[a:b] for a, b in cut], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    found = files.option("recursiveFileLookup", "true").load(f"{path}/chunks").select("content")
    return found.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
