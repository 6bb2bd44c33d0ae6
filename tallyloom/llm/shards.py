"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region, rack and shard. At each node every child of weight ``w`` draws
``-ln(u) / w`` with ``u`` in (0, 1) hashed from the row's key and the child's name, and the least
draw wins: a child is chosen in proportion to its weight, and when one child's weight changes,
rows move only into it or out of it. Hence movement stays within the subtrees whose weights change.

Edge cases: a null or repeated key goes where its hash says, all of its rows to the same shard;
a null text has no bytes and the checksum 0; an empty table gives no rows. Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a shard are numbered in so many parts, each by a task of its own.
SLOT_PARTS = 256
ROW_BYTES = 16


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def grid(n_shards: int, racks_in_region: int = 2, shards_in_rack: int = 5) -> list[Leaf]:
    """A tree of equal weights; shards are numbered region by region, rack by rack."""
    return [
        Leaf(s // (racks_in_region * shards_in_rack), s // shards_in_rack, s)
        for s in range(n_shards)
    ]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a new region.

    A shard added to a rack that is there already would raise that rack's and its region's
    weight, and rows drawn into the region would go to all of its shards. In a region of its own
    the new shard is the only subtree whose weight changes, so it alone takes rows.
    """
    return [
        *tree,
        Leaf(
            1 + max(x.region for x in tree),
            1 + max(x.rack for x in tree),
            1 + max(x.shard for x in tree),
            weight,
        ),
    ]


def _level(tree: list[Leaf], parent: str, child: str) -> dict[int, dict[int, float]]:
    found: dict[int, dict[int, float]] = {}
    for x in tree:
        if x.weight > 0:
            at = 0 if parent == "root" else getattr(x, parent)
            below = found.setdefault(at, {})
            below[getattr(x, child)] = below.get(getattr(x, child), 0.0) + x.weight
    return found


def _children(level: dict[int, dict[int, float]], at: Column) -> Column:
    def array(below: dict[int, float]) -> Column:
        return F.array(
            *[F.struct(F.lit(k).alias("id"), F.lit(float(w)).alias("w")) for k, w in below.items()]
        )

    if len(level) == 1:
        return array(next(iter(level.values())))
    by_parent = F.create_map(*[x for k, v in level.items() for x in (F.lit(k), array(v))])
    return F.element_at(by_parent, at)


def _drawn(children: Column, key: Column, level: str) -> Column:
    """The child whose draw is the least."""

    def draw(c: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), c["id"]), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((-F.ln(u) / c["w"]).alias("draw"), c["id"].alias("id"))

    return F.array_min(F.transform(children, draw))["id"]


def descend(tree: list[Leaf], key: Column) -> Column:
    """The shard of a key."""
    at: Column = F.lit(0)
    for parent, child in (("root", "region"), ("region", "rack"), ("rack", "shard")):
        at = _drawn(_children(_level(tree, parent, child), at), key, child)
    return at


def assign(
    docs: DataFrame,
    tree: list[Leaf],
    larger: list[Leaf],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each row's key, size, checksum, shard, gapless slot within it, and shard in ``larger``.

    Slots are numbered part by part: a shard's rows fall into ``SLOT_PARTS`` parts by hash, each
    part counts its own rows, and a running sum over the parts' counts (shards x parts rows,
    whatever the input) tells where each part begins.
    """
    text_bytes = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_bytes) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text_bytes, "UTF-8")).alias("text_crc32"),
        descend(tree, F.col(key)).alias("shard"),
        descend(larger, F.col(key)).alias("grown_shard"),
    ).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("part")), F.lit(SLOT_PARTS))
    )
    in_order = Window.partitionBy("shard").orderBy("part")
    begins = (
        rows.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", (F.sum("n").over(in_order) - F.col("n")).alias("begin"))
    )
    in_part = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(in_part) - 1)
        # At most shards x SLOT_PARTS rows of 20 bytes.
        .join(F.broadcast(begins), ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("begin") + F.col("nth")).cast("long").alias("slot"),
            F.col("grown_shard").cast("int").alias("grown_shard"),
        )
    )
