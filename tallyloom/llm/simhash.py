"""SimHash near-duplicates with BK-trees.

A text's fingerprint has 64 bits; two texts are linked when their fingerprints differ in at most
``max_bits``. Equal fingerprints are merged first, so copies cost one row each and no more.

* **Shards.** The 64 bits are cut into ``max_bits + 1`` bands. Fingerprints that differ in at most
  ``max_bits`` agree in one band at least, so the fingerprints that share a band's value form a
  shard, and every link lies within one. A shard with more than ``shard_rows`` fingerprints is
  cut again in the same way by the bits its members need not share yet (again one of
  ``max_bits + 1`` parts must agree). What is still large after ``CUTS`` cuts is a crowd of
  fingerprints that hardly differ: its whole tree goes to several tasks, each of which searches for
  a portion of its members. Nothing is capped.
* **BK-trees.** In each shard the fingerprints form a tree whose children are keyed by their
  Hamming distance to the parent. A search for radius r that meets a node at distance d
  follows only the edges d - r to d + r. The trees of a batch of shards are built and searched
  level by level with arrays. A shard's tree is given to the searches of that shard only, in the
  task that holds it; trees of all texts are never sent about.
* **Classes.** A shard reports its links as a star around the least fingerprint of each connected
  part, so the links are no more than its rows; the stars are joined by alternating
  large-star and small-star steps, each checkpointed.

Edge cases: a text without words (null, empty, white space) has the fingerprint 0 and is linked like
any other; with fewer words than a shingle takes, the whole sequence is the only shingle; repeated
rows are rows of the same class; a null id takes part but never names a class unless all ids of the
class are null; an empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import kept

BITS = 64
SEED = 42
CUTS = 3
#: Pairs of a search and a tree node that are held at once.
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The SimHash of one text in UTF-8: lower-cased A-Z, words joined by a space."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    begins = ends - lengths + 1
    ends = ends[min(shingle, len(words)) - 1 :]
    hashes = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        spans = zip(begins[at : at + (1 << 15)].tolist(), ends[at : at + (1 << 15)].tolist())
        h = np.array([hashes(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text: str, shingle: int, keep: list[Column]) -> DataFrame:
    """The ``keep`` columns and each text's ``fingerprint`` (a signed long)."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    out = rows.drop("__text").withColumn("fingerprint", F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            found = [fingerprint(t.as_py(), shingle) for t in texts]
            columns = [b.column(i) for i in range(b.num_columns - 1)]
            names = [*b.schema.names[:-1], "fingerprint"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], names)

    return rows.mapInArrow(run, out.schema)


def _parts(free: int, n: int) -> list[int]:
    """The bits of ``free`` in n masks of about equal size."""
    bits = [i for i in range(BITS) if free >> i & 1]
    cuts = [len(bits) * k // n for k in range(n + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def shards(prints: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """(mask, value, portion, fingerprint, searched) of every shard with two fingerprints or more.

    A portion holds its whole shard; ``searched`` marks the rows that it looks up.
    """
    all_bits = (1 << BITS) - 1

    def cut(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
        finer = F.create_map(
            *[
                x
                for k, v in masks.items()
                for x in (F.lit(_signed(k)), F.array(*[F.lit(_signed(m)) for m in v]))
            ]
        )
        return rows.select(
            F.explode(F.element_at(finer, F.col("mask"))).alias("mask"), "fingerprint"
        ).withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))

    key = ["mask", "value"]
    masks = {0: _parts(all_bits, max_bits + 1)}
    rows = cut(prints.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), masks)
    done: DataFrame | None = None
    for left in range(CUTS - 1, -1, -1):
        counts = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        counts = kept(counts)
        large = counts.where(F.col("n") > shard_rows)
        whole = rows.join(counts.where(F.col("n") <= shard_rows), key, "left_semi")
        whole = whole.select(
            *key, F.lit(0).cast("long").alias("portion"), "fingerprint", F.lit(1).alias("searched")
        )
        done = whole if done is None else done.unionByName(whole)
        if large.isEmpty():
            return done
        if left:
            fixed = [m for v in masks.values() for m in v]
            masks = {m: [m | x for x in _parts(all_bits & ~m, max_bits + 1)] for m in fixed}
            rows = cut(rows.join(large, key, "left_semi"), masks)
    portions = F.ceil(F.col("n") / shard_rows).cast("long")
    mine = F.pmod(F.xxhash64("fingerprint"), portions) == F.col("portion")
    crowds = rows.join(large, key).withColumn(
        "portion", F.explode(F.sequence(F.lit(0).cast("long"), portions - 1))
    )
    return done.unionByName(
        crowds.select(*key, "portion", "fingerprint", mine.cast("int").alias("searched"))
    )


class Forest:
    """BK-trees of many shards at once. ``group`` is sorted; each group becomes a tree."""

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.parent = np.full(n, -1, np.int64)
        self.edge = np.zeros(n, np.int64)
        self.root = np.zeros(n, np.int64)
        rows = np.arange(n)
        under = group.astype(np.int64)
        at = np.full(n, -1, np.int64)  # the node above each row's group, and the edge to it
        edge = np.zeros(n, np.int64)
        while len(rows):
            first = np.r_[True, under[1:] != under[:-1]]
            which = np.cumsum(first) - 1
            nodes = rows[first]
            self.parent[nodes] = at[first]
            self.edge[nodes] = edge[first]
            if at[0] < 0:
                self.root[rows] = nodes[which]
            rest = ~first
            rows, above = rows[rest], nodes[which[rest]]
            distance = np.bitwise_count(prints[rows] ^ prints[above]).astype(np.int64)
            order = np.lexsort((rows, distance, above))
            rows, at, edge = rows[order], above[order], distance[order]
            under = at * (BITS + 1) + edge
        self.by_parent = np.argsort(self.parent * (BITS + 1) + self.edge, kind="stable")
        self.keys = (self.parent * (BITS + 1) + self.edge)[self.by_parent]

    def search(
        self, radius: int, rows: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, other row of its tree) within the radius, for the given rows or for all."""
        rows = np.arange(len(self.prints)) if rows is None else rows
        stack = [np.stack([rows, self.root[rows]])]
        while stack:
            pairs = stack.pop()
            if pairs.shape[1] > PAIRS_AT_ONCE:
                half = pairs.shape[1] // 2
                stack += [pairs[:, half:], pairs[:, :half]]
                continue
            row, node = pairs
            d = np.bitwise_count(self.prints[row] ^ self.prints[node]).astype(np.int64)
            near = (d <= radius) & (row != node)
            yield row[near], node[near]
            # the children with edges d - radius to d + radius lie side by side
            low = np.maximum(d - radius, 1)
            high = np.minimum(d + radius, BITS)
            a = np.searchsorted(self.keys, node * (BITS + 1) + low, "left")
            b = np.searchsorted(self.keys, node * (BITS + 1) + high, "right")
            many = b - a
            total = int(many.sum())
            if total:
                begin = np.repeat(a - np.r_[0, np.cumsum(many)[:-1]], many)
                stack.append(
                    np.stack([np.repeat(row, many), self.by_parent[begin + np.arange(total)]])
                )


def _least(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the least row it is connected with.

    Pairs are folded in as they arrive, so what is held grows with the rows and not with the pairs.
    """
    label = np.arange(n)
    for a, b in pairs:
        a, b = label[a], label[b]
        joins = a != b
        a, b = a[joins], b[joins]
        while len(a):
            least = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
            np.minimum.at(label, before[a], least)
            np.minimum.at(label, before[b], least)
            label = label[label]
            if (label == before).all():
                break
        # a row points to the least of its rows, whatever it was joined with before
        while (label[label] != label).any():
            label = label[label]
    return label


def star_links(shard_rows: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) with b the least fingerprint that a is connected with in a shard; b < a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(part: np.ndarray) -> pa.RecordBatch:
            change = np.any(part[:3, 1:] != part[:3, :-1], axis=0)
            group = np.r_[0, np.cumsum(change)]
            forest = Forest(part[3].view(np.uint64), group)
            label = _least(part.shape[1], forest.search(max_bits, np.flatnonzero(part[4])))
            linked = np.flatnonzero(label != np.arange(part.shape[1]))
            return pa.RecordBatch.from_arrays(
                [pa.array(part[3, linked]), pa.array(part[3, label[linked]])], ["a", "b"]
            )

        left = np.zeros((5, 0), np.int64)
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            new = np.stack([x.astype(np.int64) for x in new])
            left = np.concatenate([left, new], axis=1)
            if left.shape[1] < 1 << 16:
                continue
            # the last shard may go on in the next batch
            same = np.all(left[:3] == left[:3, -1:], axis=0)
            whole = left.shape[1] - int(same.sum())
            if whole:
                yield solve(left[:, :whole])
                left = left[:, whole:]
        if left.shape[1]:
            yield solve(left)

    return (
        shard_rows.select("mask", "value", "portion", "fingerprint", "searched")
        .repartition("mask", "value", "portion")
        .sortWithinPartitions("mask", "value", "portion", "fingerprint")
        .mapInArrow(run, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """(a, b): b is the least of all that a is connected with; a itself is left out if least.

    Large-star hangs every larger neighbour of a node on the node's least neighbour, small-star
    every smaller one; the two alternate until nothing changes.
    """

    def step(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        side = both.where("b > a") if large else both.where("b < a")
        hung = side.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            hung = hung.unionByName(least.select("a", F.col("m").alias("b")))
        return hung.where("a <> b").distinct()

    def sign(edges: DataFrame) -> tuple:
        whole = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(edges.agg(F.count("*"), whole).first())

    edges = kept(links.distinct())
    before = None
    while (now := sign(edges)) != before:
        before = now
        edges = kept(step(step(edges, large=True), large=False))
    return edges


def classes(prints: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """(fingerprint, class) for every distinct fingerprint of ``prints``; class: the least."""
    distinct = kept(prints.select("fingerprint").distinct())
    found = components(star_links(shards(distinct, max_bits, shard_rows), max_bits))
    return distinct.join(
        found.select(F.col("a").alias("fingerprint"), F.col("b").alias("class")),
        "fingerprint",
        "left",
    ).select("fingerprint", F.coalesce("class", "fingerprint").alias("class"))


def link(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    shard_rows: int = 2048,
    also: Sequence[str] = (),
) -> DataFrame:
    """(row, doc_id, fingerprint, component_id, any ``also`` columns) for each row of ``docs``.

    ``row`` numbers the rows as Spark's scan of them gave them out, this once.
    """
    rows = kept(
        with_fingerprints(
            docs,
            text,
            shingle,
            [
                F.monotonically_increasing_id().alias("row"),
                F.col(id).alias("doc_id"),
                *[F.col(c) for c in also],
            ],
        )
    )
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    of = classes(rows, max_bits, shard_rows)
    named = of.join(least, "fingerprint")
    # Distinct fingerprints only; the rows of a class are first summed up where they are.
    names = named.groupBy("class").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(names, "class").drop("class", "least"), "fingerprint").select(
        "row", "doc_id", "fingerprint", "component_id", *also
    )


def hex16(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType))


def content_key(docs: DataFrame) -> list[Column]:
    """Two hashes of a row's columns: equal rows share them, different ones do not."""
    columns = [F.col(f.name) for f in docs.schema.fields if _hashable(f.dataType)]
    # A hash passes over nulls, so which columns are null is hashed too.
    columns.append(F.array(*[c.isNull() for c in columns]))
    return [F.xxhash64(F.lit(salt), *columns) for salt in ("key", "and another")]


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, in its own columns: that with the least id.

    The rows that stay are found again by their content, not by their place, so it does not matter
    in which order or portions a second read of ``docs`` gives them. Of several rows with the least id
    the one that was read first stays.
    """
    mark = "__key"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark = "_" + mark
    key = [f"{mark}1", f"{mark}2"]
    keyed = docs.select("*", *[k.alias(c) for k, c in zip(content_key(docs), key)])
    linked = link(keyed, id, text, also=key, **options)
    row = F.min("row").alias("row")
    copies = F.count("*").alias("copies")
    least = F.min(F.struct("row", *key, "copies")).alias("least")
    # Repeated rows are first counted where they are.
    named = linked.where(F.col("doc_id") == F.col("component_id"))
    first = named.groupBy("component_id", *key).agg(row, copies)
    first = first.groupBy("component_id").agg(least).select("least.*")
    nameless = linked.where("component_id is null")
    if not nameless.isEmpty():  # all ids of the class are null: its fingerprints name it
        of = classes(nameless, options.get("max_bits", 3), options.get("shard_rows", 2048))
        more = nameless.join(of, "fingerprint").groupBy("class", *key).agg(row, copies)
        first = first.unionByName(more.groupBy("class").agg(least).select("least.*"))
    first = kept(first)
    stay = keyed.join(first.where("copies = 1"), key, "left_semi")
    repeated = first.where("copies > 1")
    if not repeated.isEmpty():
        stay = stay.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates(key))
    return stay.select(*docs.columns)
