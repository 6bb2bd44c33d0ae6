"""Compression of vectors to one code per part, with tries over the distinct parts.

Vectors of whole numbers, floor(256 * x), are cut into consecutive parts of equal width. Each part
position has a codebook; a part's code is the index of the nearest entry (squared Euclidean distance, ties to
the lower index). Codebooks start as the parts of the rows with the smallest ids; a round of fitting assigns
every part and then replaces each entry by the floor of its parts' mean.

Parts are assigned in portions of some ten thousand rows. The distinct parts of a portion and
position, sorted, are the leaves of a lexicographic trie: a node of depth d stands for all parts that share
their first d components. The trie is walked depth first. A node's vector of distances to all entries is its
parent's plus the squares of one component, so what parts have in common is summed once; siblings are taken
together as one array. A leaf takes the least distance, and its weight, the number of its parts, goes
with it into the sums of the entry that it chose.

Nothing but these sums is shuffled, one row for each used entry and dimension from each task, and they
are exact whole numbers, so neither the cut of the portions nor a repeated task changes a codebook. The
driver holds the codebooks (positions x entries x width) and no rows beside those that start them. The input
is read a few times: for its range, for the start, once for each round, and for the codes.

Edge cases: vectors that are null or hold null or non-finite components are left out; shorter vectors are
filled up with zeros, as is a width that the number of parts does not divide; of repeated ids the
lesser vectors start a codebook first, and null ids come last; with fewer rows than entries the codebooks are
shorter; an entry that no part chose stays as it is; null labels are one label; an empty table gives no
rows. Vectors so long or large that a distance might not fit a long are refused. Other columns may have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitplanes import Shape, finite, shape_of, whole
from .shared import kept

#: Components of the vectors that are assigned together, and siblings whose distances are held at once.
PORTION = 1 << 22
TOGETHER = 4096
#: Labels whose sums are sent to all tasks; more are joined, each label in ``SALTS`` shares.
LABELS_SENT = 100_000
SALTS = 64


class Trie:
    """Lexicographic trie over distinct sorted parts, one row each."""

    def __init__(self, parts: np.ndarray):
        n, self.depth = parts.shape
        changed = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)
        first = np.ones((min(n, 1), self.depth), bool)
        #: The first leaf below each node, by depth.
        self.starts = [np.flatnonzero(x) for x in np.concatenate([first, changed]).T]
        self.values = [parts[s, d] for d, s in enumerate(self.starts)]

    def nearest(self, entries: np.ndarray, together: int = TOGETHER) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry for each leaf."""
        n = len(self.starts[-1])
        chosen, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
        root = np.zeros((1, len(entries)), entries.dtype)
        top = len(self.starts[0])
        # Nodes yet to be visited: their depth and range, their parents' distances, and where these begin.
        todo = [(0, a, min(a + together, top), root, 0) for a in range(0, top, together)][::-1]
        while todo:
            d, a, b, above, begin = todo.pop()
            own = self.values[d][a:b, None].astype(entries.dtype) - entries[:, d]
            own *= own
            if d:
                own += above[self.parent(d, a, b) - begin]
            if d == self.depth - 1:
                chosen[a:b] = own.argmin(axis=1)
                distance[a:b] = own.min(axis=1)
                continue
            below = self.starts[d + 1]
            ends = np.append(self.starts[d], n)
            low, high = np.searchsorted(below, ends[[a, b]])
            steps = [(d + 1, x, min(x + together, high), own, a) for x in range(low, high, together)]
            todo += reversed(steps)
        return chosen, distance

    def parent(self, depth: int, a: int, b: int) -> np.ndarray:
        """Which nodes one level up the nodes a to b of a depth lie below."""
        return np.searchsorted(self.starts[depth - 1], self.starts[depth][a:b], side="right") - 1


def distinct(parts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct parts in lexicographic order, which of them each part is, and how often each occurs."""
    width, base = parts.shape[1], 2 * most + 1
    if base**width < 2**62:  # a part as one number in that base, which keeps the order
        key = np.zeros(len(parts), np.int64)
        for d in range(width):
            key = key * base + (parts[:, d] + most)
        _, first, of, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return parts[first], of, n
    found, of, n = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    return found, of.reshape(-1), n


@dataclass(frozen=True)
class Codebooks:
    """Entries [position, entry, component]."""

    entries: np.ndarray
    shape: Shape

    @property
    def kind(self) -> type:
        """A type that holds all distances of a part."""
        width = self.entries.shape[2]
        return np.int32 if (2 * self.shape.most) ** 2 * max(1, width) < 2**31 else np.int64

    def digest(self) -> str:
        """SHA-256 of all components as decimals, by position, entry and component."""
        text = ",".join(map(str, self.entries.ravel().tolist()))
        return hashlib.sha256(text.encode()).hexdigest()

    def nearest(self, v: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """By position: distinct parts, their counts, which each row has, their entries and distances."""
        n_parts, _, width = self.entries.shape
        for p in range(n_parts):
            parts, of, n = distinct(v[:, p * width : (p + 1) * width], self.shape.most)
            chosen, distance = Trie(parts).nearest(self.entries[p].astype(self.kind))
            yield parts, n, of, chosen, distance


def _rows(vectors: DataFrame, id: str, vector: str, *more: str) -> DataFrame:
    x = F.transform(vector, lambda x: x.cast("double"))
    named = [F.col(c).alias(c2) for c, c2 in zip(more, ("label",))]
    return vectors.select(F.col(id).alias("id"), *named, x.alias("x")).where(finite(F.col("x")))


def _matrix(x: pa.ListArray, width: int) -> np.ndarray:
    v = np.zeros((len(x), width), np.int64)
    size = np.diff(x.offsets.to_numpy())
    v[np.arange(width) < size[:, None]] = whole(x.flatten().to_numpy(zero_copy_only=False))
    return v


def _portions(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows and their whole vectors, about ``PORTION`` components at a time."""
    most = max(1, PORTION // max(1, width))
    held: list[pa.RecordBatch] = []

    def taken():
        table = pa.Table.from_batches(held)
        x = table["x"].combine_chunks()
        return table, _matrix(x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x, width)

    for batch in batches:
        for low in range(0, len(batch), most):
            piece = batch.slice(low, most)
            if held and sum(map(len, held)) + len(piece) > most:
                yield taken()
                held = []
            held.append(piece)
    if sum(map(len, held)):
        yield taken()


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(position, entry, component, total, n): what an assignment gives each used entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, n_entries, width = books.entries.shape
        totals = np.zeros((n_parts, n_entries, width), np.int64)
        counts = np.zeros((n_parts, n_entries), np.int64)
        for _, v in _portions(batches, n_parts * width):
            for p, (parts, n, _, chosen, _) in enumerate(books.nearest(v)):
                np.add.at(totals[p], chosen, parts * n[:, None])
                np.add.at(counts[p], chosen, n)
        p, e = np.nonzero(counts)
        of = lambda x: pa.array(np.repeat(x, width))
        component, total = np.tile(np.arange(width), len(p)), totals[p, e].ravel()
        yield pa.RecordBatch.from_arrays(
            [of(p), of(e), pa.array(component), pa.array(total), of(counts[p, e])],
            ["position", "entry", "component", "total", "n"],
        )

    found = rows.select("x").mapInArrow(
        run, "position long, entry long, component long, total long, n long"
    )
    return found.groupBy("position", "entry", "component").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )


def fit(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id: str = "vec_id",
    vector: str = "embedding",
) -> Codebooks:
    """Codebooks after some rounds of assignment and means."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: need 1 to 256 entries")
    rows = _rows(vectors, id, vector)
    shape = shape_of(rows, "x")
    width = max(1, -(-shape.width // parts))
    if 4 * shape.bound >= 2**62:
        raise ValueError("vectors so long or large that a distance may not fit a long")
    first = rows.orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
    v = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        v[i, : len(r.x)] = whole(np.array(r.x, np.float64))
    found = v.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        sums = _sums(rows, Codebooks(found, shape)).collect()  # parts * entries * width rows at most
        for r in sums:
            found[r.position, r.entry, r.component] = r.total // r.n
    return Codebooks(found, shape)


def encode(
    vectors: DataFrame,
    books: Codebooks,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(id, label, code, error): a byte for each part, and the squared distance of the whole vector."""
    rows = _rows(vectors, id, vector, label)
    schema = rows.drop("x").withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_parts, _, width = books.entries.shape
        for table, v in _portions(batches, n_parts * width):
            codes, error = np.zeros((len(v), n_parts), np.uint8), np.zeros(len(v), np.int64)
            for p, (_, _, of, chosen, distance) in enumerate(books.nearest(v)):
                codes[:, p] = chosen[of]
                error += distance[of]
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            out = [table["id"], table["label"], packed, pa.array(error)]
            yield from pa.table(out, names=schema.names).to_batches()

    return rows.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """The rows with the vector that each code stands for, as ``decoded``."""
    flat = F.lit(books.entries.reshape(books.entries.shape[0], -1).tolist())
    width = books.entries.shape[2]

    def part(p):
        at = F.conv(F.hex(F.substring(code, p + 1, 1)), 16, 10).cast("int")
        return F.transform(F.slice(flat[p], at * width + 1, width), lambda x: x / F.lit(256.0))

    return codes.withColumn("decoded", F.concat(*[part(p) for p in range(len(books.entries))]))


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows of ``encode`` with the errors of their label summed, null labels together.

    Sums are taken before anything is joined. Few labels go to all tasks; many are joined with each
    label's rows in ``SALTS`` shares, so a label with a third of all rows is no task's burden.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    c, s = coded.alias("c"), sums.alias("s")
    same = F.col("c.label").eqNullSafe(F.col("s.label"))
    if sums.limit(LABELS_SENT + 1).count() <= LABELS_SENT:
        joined = c.join(F.broadcast(s), same)
    else:
        salt = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int")
        c = coded.withColumn("salt", salt).alias("c")
        s = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("s")
        joined = c.join(s, same & (F.col("c.salt") == F.col("s.salt")))
    return joined.select("c.id", "c.label", "c.code", "c.error", "s.label_error")


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """Fitted codebooks, and (id, label, code, error, label_error) of every usable row."""
    books = fit(vectors, parts, entries, rounds, id, vector)
    return with_label_error(kept(encode(vectors, books, id, vector, label))), books
