"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

* **Blocks.** Each source is cut into ``BLOCKS`` blocks of documents by a seeded hash, which is a
  random permutation that needs no sort. Equal rows are numbered, and the number goes into the hash, so a
  document that is repeated a thousand times lies in many blocks. Block sums are exact sums over
  all documents.
* **Quotas.** A source's blocks stand in a permuted order: whole passes over all of them, then those that
  fit what is left of its target. How many of that order meet the target is its quota.
* **Splitting tree.** The quotas are split among the output shards: a node with n shards hands its
  left half a multivariate-hypergeometric draw of its blocks and its right half the rest, down to single
  shards. Every shard so gets its exact number of blocks, and sources mix as if all blocks had
  been shuffled together. Sources are taken in up to ``GROUPS`` groups: the tree splits the sums of
  the groups first, and then each group's share among its sources in a task of its own.
* **Draws.** Each shard draws the next blocks of a source's order, as many as the tree gave it; runs of
  different shards are disjoint. A document is taken once for each shard that drew its block.
* **Local order.** Within a shard documents are ordered by a random key of their own.

What reaches the driver are sums, counts and one row per group of sources. A source has at most ``BLOCKS``
block rows, whatever its size, so a hot source is no larger a group than others, and no number of sources is too
many.

Edge cases: a null text has no words, documents without words are never taken; sources are ordered
by code point with null last; of equal rows any may be the one that is taken; an empty table gives no rows.
Columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free_prefix, kept, n_words

BLOCKS = 1024
GROUPS = 1024
#: A table of blocks, or of repeated rows' keys, up to this many rows (of about 100 bytes) is
#: broadcast, a larger one joined.
BROADCAST_ROWS = 100_000
#: Bits of monotonically_increasing_id() that number the rows of a partition.
ROW_BITS = 33


def targets(sizes: list[int], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size.

    What a source cannot take is shared by weight among those that can, until none is above.
    """
    total = float(sum(sizes))
    cap = most * np.array(sizes, dtype=float)
    w = np.array(weights, dtype=float)
    full = np.zeros(len(sizes), bool)
    out = np.zeros(len(sizes))
    while True:
        rest = total - cap[full].sum()
        share = np.where(full, 0.0, w)
        out = np.where(full, cap, rest * share / share.sum() if share.sum() > 0 else 0.0)
        above = ~full & (out > cap)
        if not above.any():
            return out.tolist()
        full |= above


def split(
    quotas: np.ndarray, shards: int, seed: int, totals: np.ndarray | None = None
) -> np.ndarray:
    """(sources, shards): how many of each source's blocks each shard gets.

    ``totals`` are the blocks that each shard gets in all; by default they differ by one at most.
    """
    out = np.zeros((len(quotas), shards), np.int64)

    def node(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = have
            return
        mid = (low + high) // 2
        if totals is None:
            # shard k holds the blocks from total * k // n on: counts differ by one at most
            left = int(have.sum()) * (mid - low) // (high - low)
        else:
            left = int(totals[low:mid].sum())
        rng = np.random.default_rng([seed, low, high])
        drawn = rng.multivariate_hypergeometric(have, left, method="marginals")
        node(drawn, low, mid)
        node(have - drawn, mid, high)

    if len(quotas):
        node(np.asarray(quotas, np.int64), 0, shards)
    return out


def order_blocks(words: np.ndarray, target: float, seed: list[int]) -> tuple[list[int], int]:
    """The order in which a source's blocks are drawn, and how many of it meet the target."""
    some = np.flatnonzero(words > 0)
    size = int(words.sum())
    if not size:
        return [], 0
    rng = np.random.default_rng(seed)
    passes = min(int(target // size), 3)
    order = [i for _ in range(passes) for i in rng.permutation(some).tolist()]
    last = rng.permutation(some)
    left = round(target) - passes * size
    fit, rest = [], []
    for i in last.tolist():
        if words[i] <= left:
            fit.append(i)
            left -= int(words[i])
        else:
            rest.append(i)
    # one more block if that comes nearer to the target
    if rest and left > 0:
        nearest = min(range(len(rest)), key=lambda j: abs(int(words[rest[j]]) - left))
        if abs(int(words[rest[nearest]]) - left) < left:
            fit.append(rest.pop(nearest))
    return order + fit + rest, len(order) + len(fit)


def _sources_of(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The blocks of each source of a group."""
    pdf = pdf.sort_values(["nth", "block"], ignore_index=True)
    cuts = np.flatnonzero(np.diff(pdf["nth"].to_numpy())) + 1
    for low, high in zip([0, *cuts], [*cuts, len(pdf)]):
        yield pdf.iloc[low:high]


def _quotas(seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """How many blocks of its order each source of a group gives."""
        found = [
            (r["nth"].iloc[0], order_blocks(r["words"].to_numpy(), r["target"].iloc[0], [seed, r["nth"].iloc[0]])[1])
            for r in _sources_of(pdf)
        ]
        return pd.DataFrame(
            {"group": pdf["group"].iloc[0], "nth": [x for x, _ in found], "quota": [x for _, x in found]}
        )

    return run


def _draws(seed: int, shards: int, totals: dict[int, list[int]]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The shards that draw each block of a group's sources; a block may be drawn several times."""
        sources = list(_sources_of(pdf))
        orders = [
            order_blocks(r["words"].to_numpy(), r["target"].iloc[0], [seed, r["nth"].iloc[0]])
            for r in sources
        ]
        group = int(pdf["group"].iloc[0])
        quotas = np.array([n for _, n in orders], np.int64)
        lots = split(quotas, shards, seed + 1 + group, np.array(totals[group], np.int64))
        out = []
        for rows, (order, _), lot in zip(sources, orders, lots):
            drawn: list[list[int]] = [[] for _ in range(len(rows))]
            for place, shard in enumerate(np.repeat(np.arange(shards), lot).tolist()):
                drawn[order[place]].append(shard)
            out.append(pd.Series(drawn, rows.index))
        return pd.concat(sources).assign(shards=pd.concat(out)).drop(columns=["group", "words"])

    return run


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place ``nth`` in the order of names, null last."""
    place = F.monotonically_increasing_id()
    ordered = sources.repartitionByRange("is_null", "name").sortWithinPartitions("is_null", "name")
    placed = kept(
        ordered.withColumns(
            {"part": F.shiftright(place, ROW_BITS), "at": place.bitwiseAND((1 << ROW_BITS) - 1)}
        )
    )
    before, n = {}, 0
    for r in placed.groupBy("part").count().orderBy("part").collect():  # one row per task
        before[r.part], n = n, n + r["count"]
    if not before:
        return placed.select("name", "is_null", F.col("words").alias("source_size"), F.col("at").alias("nth"))
    first = F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair])
    return placed.select(
        "name", "is_null", F.col("words").alias("source_size"), (first[F.col("part")] + F.col("at")).alias("nth")
    )


def _with_targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """Sources with their ``target``, as ``targets`` has it for weights 1, 2, 3, repeating.

    Each round takes out the sources whose share is above what they can take; the shares of the others
    grow, so who is out stays out. A round is one sum over the sources, and few are needed.
    """
    weight = (1 + F.col("nth") % 3).cast("double")
    cap = F.lit(most) * F.col("source_size").cast("double")
    total, weights = sources.agg(F.sum(F.col("source_size").cast("double")), F.sum(weight)).first()
    rest, full = total or 0.0, 0
    while True:
        share = F.lit(rest) * weight / F.lit(weights or 1.0)
        above = share > cap
        n, caps, open_weights = sources.agg(
            F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, weight))
        ).first()
        if n == full:
            return sources.withColumn("target", F.when(above, cap).otherwise(share))
        if not open_weights:
            return sources.withColumn("target", cap)
        full, rest, weights = n, total - caps, open_weights


def _numbered(rows: DataFrame, key: str, nth: str) -> DataFrame:
    """The rows with a number from 0 among those of equal key; any order will do.

    Keys that occur once need none. Rows of the others are numbered within the portion they were read
    in, and portions by running sums, so a key with very many rows is no task's burden.
    """
    repeated = kept(rows.groupBy(key).agg(F.count(F.lit(1)).alias(nth)).where(F.col(nth) > 1))
    n = repeated.count()
    if not n:
        return rows.withColumn(nth, F.lit(0).cast("long"))
    if n <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    part = f"{nth}_part"
    many = kept(rows.join(repeated, key, "left_semi").withColumn(part, F.spark_partition_id()))
    own = Window.partitionBy(key, part).orderBy(key)
    so_far = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = many.groupBy(key, part).agg(F.count(F.lit(1)).alias(nth))
    before = sums.select(key, part, F.coalesce(F.sum(nth).over(so_far), F.lit(0)).alias(f"{nth}_before"))
    numbered = many.withColumn(nth, F.row_number().over(own) - 1).join(before, [key, part])
    return (
        rows.join(repeated, key, "left_anti")
        .withColumn(nth, F.lit(0).cast("long"))
        .unionByName(
            numbered.withColumn(nth, F.col(nth) + F.col(f"{nth}_before")).select(*rows.columns, nth)
        )
    )


def plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shards: int = 16,
    seed: int = 20240,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``shards``.

    ``shards`` says which shards draw the document, ``copies`` how many do. Weights are 1, 2, 3, repeating,
    over the sources in order.
    """
    p = prefix
    key = F.xxhash64(F.lit(seed), F.col(id), F.col(text), F.col(source))
    rows = _numbered(docs.withColumn(f"{p}key", key), f"{p}key", f"{p}again")
    sized = rows.select(
        *[F.col(c) for c in docs.columns],
        n_words(F.col(text)).alias(f"{p}size"),
        F.coalesce(F.col(source), F.lit("")).alias(f"{p}name"),
        F.col(source).isNull().alias(f"{p}null"),
        F.pmod(F.xxhash64(f"{p}key", f"{p}again"), F.lit(BLOCKS)).alias(f"{p}block"),
    )
    blocks = kept(
        sized.groupBy(
            F.col(f"{p}name").alias("name"),
            F.col(f"{p}null").alias("is_null"),
            F.col(f"{p}block").alias("block"),
        ).agg(F.sum(f"{p}size").alias("words"))
    )
    sources = kept(_with_targets(_ranked(blocks.groupBy("name", "is_null").agg(F.sum("words").alias("words")))))
    per_group = max(1, -(-sources.count() // GROUPS))
    group = F.floor(F.col("nth") / per_group).alias("group")
    columns = "name string, is_null boolean, nth long, source_size long, target double, block long"
    of = (
        blocks.join(sources, ["name", "is_null"])
        .select("name", "is_null", "nth", "source_size", "target", "block", "words", group)
    )
    quotas = of.groupBy("group").applyInPandas(_quotas(seed), "group long, nth long, quota long")
    sums = quotas.groupBy("group").agg(F.sum("quota").alias("quota")).orderBy("group").collect()
    lots = split(np.array([r.quota for r in sums], np.int64), shards, seed)
    totals = {r.group: lot.tolist() for r, lot in zip(sums, lots)}
    drawn = of.groupBy("group").applyInPandas(
        _draws(seed, shards, totals), f"{columns}, shards array<long>"
    )
    names = {"name": "name", "is_null": "null", "block": "block"}
    names |= {c: c for c in ("source_size", "target", "shards")}
    dealt = kept(drawn.select(*[F.col(a).alias(f"{p}{b}") for a, b in names.items()]))
    if dealt.count() <= BROADCAST_ROWS:
        dealt = F.broadcast(dealt)
    return (
        sized.join(dealt, [f"{p}name", f"{p}null", f"{p}block"])
        .withColumn(f"{p}copies", F.size(f"{p}shards").cast("long"))
        .drop(f"{p}name", f"{p}null", f"{p}block")
    )


def mix(docs: DataFrame, words_in_task: int = 2_000_000, seed: int = 20240, **options) -> DataFrame:
    """The mixed documents in their own columns, each as often as it is taken.

    Written, the rows lie shard by shard in random order. A shard's rows are ordered in slices of
    the random key, each by a task of its own, so shards may be of any size.
    """
    p = free_prefix(docs.columns)
    shards = options.setdefault("shards", 16)
    taken = plan(docs, prefix=p, seed=seed, **options).where(F.col(f"{p}copies") > 0)
    copies = taken.select(
        *[F.col(c) for c in docs.columns], F.posexplode(f"{p}shards").alias(f"{p}copy", f"{p}shard")
    )
    id, text = options.get("id", "doc_id"), options.get("text", "text")
    order: Column = F.xxhash64(F.lit(seed + 1), F.col(id), F.col(text), F.col(f"{p}copy"))
    total = taken.agg(F.sum(F.col(f"{p}size") * F.col(f"{p}copies"))).first()[0] or 0
    slices = max(1, -(-int(total) // (shards * words_in_task)))
    return (
        copies.withColumn(f"{p}order", order)
        .withColumn(f"{p}slice", F.pmod(F.col(f"{p}order"), F.lit(slices)))
        .repartition(f"{p}shard", f"{p}slice")
        .sortWithinPartitions(f"{p}shard", f"{p}slice", f"{p}order")
        .select(*docs.columns)
    )


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per document its size, its source's size and target, the words that the mix takes, and their shards."""
    id, text, source = (options.get(k, v) for k, v in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    p = free_prefix([id, text, source])
    return plan(docs.select(id, text, source), prefix=p, **options).select(
        id,
        *[F.col(f"{p}{c}").alias(c) for c in ("size", "source_size", "target")],
        (F.col(f"{p}size") * F.col(f"{p}copies")).alias("taken"),
        F.concat_ws(",", F.transform(f"{p}shards", lambda x: x.cast("string"))).alias("shards"),
    )
