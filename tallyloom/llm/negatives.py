"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Anchors are the rows whose id ``every`` divides. An anchor's positives are its best other rows of
the same label. For each of them the negatives are the best rows of different labels whose score is
from ``lower`` to ``upper`` per cent of the positive's score, both included. Scores are exact inner
products of floor(256 * x), taken by tables of subset sums (``bitplanes``).

Rows are packed into bit planes where they are read and checkpointed in that form, a fraction of the
vectors' size; so rows keep their numbers however often the checkpoint is read. Candidates lie in blocks
and anchors in portions of bounded size, by a hash of the row and not of the label, so no label is
too large for a task. A block and a portion meet twice: for the positives only rows of equal labels
are scored; for the negatives, whose bounds the positives set, all others. Each meeting
returns the best few per anchor, and these are merged over all blocks. No row is left unscored.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part; shorter
vectors are filled up with zeros; ties go to the smaller id, a null id after all others, then to the row that
comes first; a null id is never an anchor; repeated rows are rows, and an anchor leaves out its own row
only; fewer rows than asked for give fewer; a positive of a negative score has no negatives, as
no score meets both bounds; an empty table gives none. Vectors so long or large that an inner product might
not fit a long are refused. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bitplanes
from .bitplanes import Shape
from .shared import kept

BLOCK_ROWS = 4096
ANCHOR_ROWS = 4096
#: Anchors whose scores are held at once.
STEP = 256


def packed(rows: DataFrame, shape: Shape) -> DataFrame:
    """(row, id, label, planes) of rows (row, id, label, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            v = np.zeros((len(x), shape.width), np.int64)
            size = np.diff(x.offsets.to_numpy())
            inside = np.arange(shape.width) < size[:, None]
            v[inside] = bitplanes.whole(x.flatten().to_numpy(zero_copy_only=False))
            planes = bitplanes.pack(v, shape)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("row", "id", "label")],
                    pa.array([p.tobytes() for p in planes], pa.binary()),
                ],
                ["row", "id", "label", "planes"],
            )

    schema = rows.drop("x").withColumn("planes", F.lit(b"")).schema
    return rows.mapInArrow(run, schema)


def _planes(column: pa.ChunkedArray, shape: Shape) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return flat.reshape(len(column), shape.bits, shape.groups)


class Meeting:
    """Candidates of a block, best id first, and the anchors of a portion."""

    def __init__(self, table: pa.Table, shape: Shape):
        codes = pc.dictionary_encode(table["label"]).combine_chunks().indices
        table = table.append_column("code", codes)
        is_anchor = table["is_anchor"]
        order = [("id", "ascending"), ("row", "ascending")]
        self.shape = shape
        self.anchors = table.filter(is_anchor)
        some = table.filter(pc.invert(is_anchor))
        self.candidates = some.take(pc.sort_indices(some, order, null_placement="at_end"))
        self.n = len(self.candidates)
        self.code = self.candidates["code"].to_numpy()
        self.anchor_code = self.anchors["code"].to_numpy()
        self.planes = _planes(self.candidates["planes"], shape)
        self.queries = bitplanes.unpack(_planes(self.anchors["planes"], shape), shape)
        # A key orders scores and, among equal ones, places; below all keys is what takes no part.
        self.kind = np.int64 if (shape.bound + 2) * (self.n + 1) < 2**62 else object
        self.none = -(shape.bound + 1) * self.n - 1

    def keys(self, places: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """score * n + (n - 1 - place) for each anchor and each of the places."""
        found = bitplanes.scores(self.planes[places], self.queries[anchors], self.shape).T
        return found.astype(self.kind) * self.n + (self.n - 1 - places)

    def read(self, keys: list[int]) -> tuple[list[int], list[int]]:
        """Places and scores."""
        return [self.n - 1 - k % self.n for k in keys], [k // self.n for k in keys]


def _positives(shape: Shape, k: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema(
        [("anchor_row", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())]
    )

    def run(table: pa.Table) -> pa.Table:
        m = Meeting(table, shape)
        at, own, scores = [], [], []
        place = dict(zip(m.candidates["row"].to_pylist(), range(m.n)))
        rows = m.anchors["row"].to_pylist()
        for code in np.unique(m.anchor_code):
            places = np.flatnonzero(m.code == code)
            same = np.flatnonzero(m.anchor_code == code)
            for low in range(0, len(same) if len(places) else 0, STEP):
                anchors = same[low : low + STEP]
                keys = m.keys(places, anchors)
                for i, a in enumerate(anchors):
                    if rows[a] in place:
                        keys[i, np.searchsorted(places, place[rows[a]])] = m.none
                keys = np.sort(keys, axis=1)[:, -k:]
                for a, best in zip(anchors, keys):
                    found, score = m.read([x for x in best.tolist() if x != m.none])
                    at += found
                    scores += score
                    own += [rows[a]] * len(found)
        chosen = m.candidates.take(pa.array(at, pa.int64()))
        own, scores = pa.array(own, pa.int64()), pa.array(scores, pa.int64())
        return pa.table([own, chosen["id"], chosen["row"], scores], schema=schema)

    return run


def _negatives(shape: Shape, k: int, lower: int, upper: int) -> Callable[[pa.Table], pa.Table]:
    schema = pa.schema(
        [
            ("anchor_row", pa.int64()),
            ("nth", pa.int64()),
            ("id", pa.int64()),
            ("row", pa.int64()),
            ("score", pa.int64()),
        ]
    )

    def run(table: pa.Table) -> pa.Table:
        m = Meeting(table, shape)
        at, own, nth, scores = [], [], [], []
        rows = m.anchors["row"].to_pylist()
        bounds = m.anchors["positive_scores"].to_pylist()
        places = np.arange(m.n)
        for low in range(0, len(rows) if m.n else 0, STEP):
            anchors = np.arange(low, min(low + STEP, len(rows)))
            keys = m.keys(places, anchors)
            keys[m.anchor_code[anchors][:, None] == m.code] = m.none
            keys.sort(axis=1)
            for a, by_score in zip(anchors, keys):
                for i, positive in enumerate(bounds[a]):
                    least, most = -(-lower * positive // 100), upper * positive // 100
                    if least > most:
                        continue
                    end = np.searchsorted(by_score, (most + 1) * m.n)
                    best = by_score[max(0, end - k) : end].tolist()
                    found, score = m.read([x for x in best if x != m.none and x >= least * m.n])
                    at += found
                    scores += score
                    own += [rows[a]] * len(found)
                    nth += [i] * len(found)
        chosen = m.candidates.take(pa.array(at, pa.int64()))
        own, nth, scores = (pa.array(x, pa.int64()) for x in (own, nth, scores))
        return pa.table([own, nth, chosen["id"], chosen["row"], scores], schema=schema)

    return run


def _meet(
    candidates: DataFrame, anchors: DataFrame, blocks: int, portions: int, run, schema: str
) -> DataFrame:
    """``run`` on the candidates of each block with the anchors of each portion."""
    spread = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    both = (
        candidates.withColumn("block", spread(blocks, "block"))
        .withColumn("portion", all_of(portions))
        .withColumn("is_anchor", F.lit(False))
        .unionByName(
            anchors.withColumn("portion", spread(portions, "portion"))
            .withColumn("block", all_of(blocks))
            .withColumn("is_anchor", F.lit(True)),
            allowMissingColumns=True,
        )
    )
    return both.groupBy("block", "portion").applyInArrow(run, schema)


def _first(found: DataFrame, n: int, *of: str) -> DataFrame:
    """The n best rows of each group, with their rank."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(
    vectors: DataFrame,
    every: int = 50,
    n_positives: int = 5,
    n_negatives: int = 3,
    lower: int = 50,
    upper: int = 95,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("long").alias("id"),
        F.col(label).alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("x"),
    ).where(F.col("label").isNotNull() & bitplanes.finite(F.col("x")))
    shape = bitplanes.shape_of(rows, "x")
    whole = kept(packed(rows, shape))
    anchors = whole.where(F.col("id") % every == 0)
    blocks = max(1, -(-shape.rows // block_rows))
    portions = max(1, -(-anchors.count() // anchor_rows))

    positives = _first(
        _meet(
            whole, anchors, blocks, portions,
            _positives(shape, n_positives), "anchor_row long, id long, row long, score long",
        ),
        n_positives,
        "anchor_row",
    )
    lists = positives.groupBy(F.col("anchor_row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")
    )
    asked = kept(
        anchors.join(lists, "row").select(
            "row",
            "id",
            "label",
            "planes",
            F.col("positives.id").alias("positive_ids"),
            F.col("positives.score").alias("positive_scores"),
        )
    )
    negatives = _first(
        _meet(
            whole, asked.drop("positive_ids"), blocks, portions,
            _negatives(shape, n_negatives, lower, upper),
            "anchor_row long, nth long, id long, row long, score long",
        ),
        n_negatives,
        "anchor_row", "nth",
    )
    of = asked.select(
        F.col("row").alias("anchor_row"),
        F.col("id").alias("anchor_id"),
        "positive_ids",
        "positive_scores",
    )
    at = F.col("nth").cast("int")
    return negatives.join(of, "anchor_row").select(
        "anchor_id",
        F.get("positive_ids", at).alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.get("positive_scores", at).alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
