"""Byte-level BPE: encoding by segment trees of pair ranks, and decoding.

A text is split by the tokenizer's pattern; each piece is merged by itself. A piece's bytes are the
leaves of a segment tree. Leaf i holds the rank of the pair that begins at byte i (no pair:
infinity), an inner node the least rank below and with it the leftmost place that has it, so the
root names the next merge. A merge changes three leaves: that of the merged token, that of its left
neighbour, and that of the token swallowed, which dies; each is put right in logarithmic time.
Neighbours are kept as a linked list of live tokens.

Pieces recur, so each task keeps a bounded table of pieces it has encoded, and new pieces of a batch
are merged together: all trees of a size are rows of one array, and one step of the
loop makes the next merge of every piece. Long pieces (over ``LONG`` bytes) are merged one by one on
the same tree.

A pair's rank is that of the two tokens' joined bytes, as in the tiktoken library. The vocabulary
is of a fixed size and goes to the tasks as a broadcast of a few MB.

Edge cases: a null or empty text has no tokens and decodes to no bytes; texts are never cut; repeated
rows are rows; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_prefix

#: Pieces of more bytes than this are merged one by one.
LONG = 64
#: Encoded pieces that a task keeps at most from one portion to the next; then it begins anew.
KEPT_PIECES = 300_000
#: New pieces that are merged together at most.
TOGETHER = 50_000
NONE = np.int64(1) << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class Vocabulary:
    """Ranks of tokens, and of pairs of tokens as a sorted array for look-ups of many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.span = 1 + max(ranks.values())
        keys, found = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.span + b)
                    found.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.r_[np.array(keys, np.int64)[order], np.iinfo(np.int64).max]
        self.pair_ranks = np.r_[np.array(found, np.int64)[order], NONE]
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, ``NONE`` where there is none or a side is missing (-1)."""
        key = a * self.span + b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NONE)


class Trees:
    """A segment tree for each row of ``width`` leaves; a leaf's key is rank * width + place."""

    def __init__(self, ranks: np.ndarray):
        n, width = ranks.shape
        self.width = width
        self.node = np.full((n, 2 * width), NONE * width, np.int64)
        self.node[:, width:] = ranks * width + np.arange(width)
        level = width
        while level > 1:
            level //= 2
            below = self.node[:, 2 * level : 4 * level]
            self.node[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])

    def least(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least rank of each row, and the leftmost place that has it."""
        return np.divmod(self.node[rows, 1], self.width)

    def put(self, rows: np.ndarray, place: np.ndarray, rank: np.ndarray) -> None:
        at = place + self.width
        self.node[rows, at] = rank * self.width + place
        while self.width > 1:
            at >>= 1
            self.node[rows, at] = np.minimum(self.node[rows, 2 * at], self.node[rows, 2 * at + 1])
            if at[0] == 1:
                return


def _merge_all(pieces: list[bytes], width: int, v: Vocabulary) -> list[np.ndarray]:
    """Token ids of each piece; all have at most ``width`` bytes, a power of two."""
    n = len(pieces)
    length = np.fromiter(map(len, pieces), np.int64, n)
    ids = np.full((n, width + 1), -1, np.int64)  # the last column is beyond any text
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    inside = np.arange(width) < length[:, None]
    ids[:, :width][inside] = v.of_byte[flat]
    nxt = np.tile(np.arange(1, width + 2), (n, 1))
    nxt[:, width] = width
    nxt = np.minimum(nxt, np.where(np.arange(width + 1) + 1 < length[:, None], nxt, width))
    prev = np.tile(np.arange(-1, width), (n, 1))
    trees = Trees(v.pair(ids[:, :width], ids[:, 1 : width + 1]))
    rows = np.arange(n)
    while len(rows):
        rank, at = trees.least(rows)
        live = rank < NONE
        rows, rank, at = rows[live], rank[live], at[live]
        if not len(rows):
            break
        gone = nxt[rows, at]
        after = nxt[rows, gone]
        ids[rows, at] = rank
        ids[rows, gone] = -1
        nxt[rows, at] = after
        prev[rows, np.minimum(after, width)] = at
        trees.put(rows, gone, np.full(len(rows), NONE))
        trees.put(rows, at, v.pair(rank, ids[rows, after]))
        before = prev[rows, at]
        has = before >= 0
        if has.any():
            r, b = rows[has], before[has]
            trees.put(r, b, v.pair(ids[r, b], rank[has]))
    return [row[row >= 0] for row in ids[:, :width]]


def _merge_long(piece: bytes, v: Vocabulary) -> list[int]:
    """The same on one tree in plain lists, for a piece of any length."""
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    ids = v.of_byte[np.frombuffer(piece, np.uint8)]
    ranks = np.full((1, width), NONE, np.int64)
    ranks[0, : n - 1] = v.pair(ids[:-1], ids[1:])
    tree = Trees(ranks).node[0].tolist()
    ids, nxt, prev = ids.tolist(), [*range(1, n + 1)], [*range(-1, n - 1)]
    none = int(NONE) * width
    table: dict[int, int] = dict()
    keys, pair_ranks, span = v.keys, v.pair_ranks, v.span

    def pair(a: int, b: int) -> int:
        key = a * span + b
        if key not in table:
            at = int(np.searchsorted(keys, key))
            table[key] = int(pair_ranks[at]) if keys[at] == key else int(NONE)
        return table[key]

    def put(place: int, rank: int) -> None:
        at = place + width
        tree[at] = rank * width + place
        at >>= 1
        while at:
            a, b = tree[2 * at], tree[2 * at + 1]
            least = a if a < b else b
            if tree[at] == least:
                return
            tree[at] = least
            at >>= 1

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = nxt[at]
        after = nxt[gone]
        ids[at], ids[gone], nxt[at] = rank, -1, after
        put(gone, int(NONE))
        if after < n:
            prev[after] = at
            put(at, pair(rank, ids[after]))
        else:
            put(at, int(NONE))
        if prev[at] >= 0:
            put(prev[at], pair(ids[prev[at]], rank))
    return [x for x in ids if x >= 0]


def merge(pieces: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Token ids of each piece (none empty)."""
    out: list[np.ndarray | None] = [None] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        whole = v.ranks.get(piece)
        if whole is not None:
            out[i] = np.array([whole])
        elif len(piece) > LONG:
            out[i] = np.array(_merge_long(piece, v))
        else:
            by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
    for width, at in by_width.items():
        for low in range(0, len(at), TOGETHER):
            some = at[low : low + TOGETHER]
            for i, ids in zip(some, _merge_all([pieces[i] for i in some], width, v)):
                out[i] = ids
    return out  # type: ignore[return-value]


class Encoder:
    """Encodes texts to ids as little-endian integers of ``dtype``."""

    def __init__(self, v: Vocabulary, pattern: str, dtype: str = "<u4"):
        self.v, self.dtype = v, dtype
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def learn(self, new: set[str], table: dict[str, bytes]) -> None:
        """Encode pieces that the table doesn't have yet."""
        todo = list(new)
        for low in range(0, len(todo), TOGETHER):
            some = todo[low : low + TOGETHER]
            found = merge([p.encode("utf-8", "surrogatepass") for p in some], self.v)
            table |= {p: ids.astype(self.dtype).tobytes() for p, ids in zip(some, found)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split = [self.pieces(t) for t in texts]
        distinct = set().union(*split) if split else set()
        new = distinct - self.known.keys()
        table = self.known
        if len(table) + len(new) > KEPT_PIECES:  # begin anew with the pieces of these texts
            table = {p: table[p] for p in distinct - new}
            self.known = {}
        self.learn(new, table)
        # These texts may have more pieces than are kept: they are looked up in all of them.
        self.known = table if len(table) <= KEPT_PIECES else dict(islice(table.items(), KEPT_PIECES))
        known = table.__getitem__
        return [b"".join(map(known, pieces)) for pieces in split]


def decode(ids: np.ndarray, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def in_portions(texts: pa.Array, most: int = 4 << 20) -> Iterator[list[str]]:
    """The texts of an Arrow column, a few MB at a time; null as the empty text."""
    some, size = [], 0
    for t in texts:
        some.append(t.as_py() or "")
        size += len(some[-1])
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


class Tokenizer:
    """A vocabulary and pattern, sent to the executors once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.pattern = pattern
        self.sent = spark.sparkContext.broadcast(read_ranks(path))

    def encoder(self, dtype: str = "<u4") -> Encoder:
        return Encoder(Vocabulary(self.sent.value), self.pattern, dtype)


def encode(
    docs: DataFrame, tokenizer: Tokenizer, keep: list[Column], text: str = "text"
) -> DataFrame:
    """The ``keep`` columns with ``n_tokens``, ``ids`` (binary) and ``decoded`` digests."""
    name = free_prefix(docs.select(*keep).columns)
    rows = docs.select(*keep, F.col(text).alias(name))
    schema = (
        rows.drop(name)
        .withColumns(
            {
                "n_tokens": F.lit(0).cast("long"),
                "ids": F.lit(b""),
                "ids_sha256": F.lit(""),
                "decoded_sha256": F.lit(""),
            }
        )
        .schema
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        tokens = encoder.v.tokens
        for batch in batches:
            done = 0
            for texts in in_portions(batch.column(batch.num_columns - 1)):
                part = batch.slice(done, len(texts))
                done += len(texts)
                ids = encoder.encode_all(texts)
                decoded = [decode(np.frombuffer(x, "<u4"), tokens) for x in ids]
                sha = lambda x: hashlib.sha256(x).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in range(batch.num_columns - 1)],
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(map(sha, ids), pa.string()),
                        pa.array(map(sha, decoded), pa.string()),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)
