"""Exact top-k inner products by the threshold algorithm over sorted lists.

Vectors are made of integers, floor(256 * x) of each component. Candidates lie in blocks of
bounded size; for each block every dimension has a list of its rows sorted by that component.
A query reads all lists from the end that its own component's sign favours, a growing number
of entries at a time. A row seen in any list is scored in full. The threshold is the inner product of
the query with the components last read: no unseen row can score more. Once it is below
the k-th best score, the block is done (at equality it goes on, for an unseen row could
tie with a smaller id). A block gives k rows per query, and these are merged over all blocks.

Sums are exact: they are taken in 32-bit floats, 64-bit floats or whole Python numbers, as the
size of the components allows. Rows are numbered once, in a checkpoint, so a query knows its own row however
often the vectors are read.

Queries and candidates meet block by block; nothing is broadcast. The work is that of the stated query
set against all rows, less what the thresholds save.

Edge cases: vectors that are null or hold null or non-finite components take no part; shorter vectors are
filled up with zeros; ties go to the smaller id, then to the row that comes first (a null
id is never a query and comes after all others); repeated rows are rows, and a query
leaves out its own row only; fewer than k candidates give fewer rows; an empty table gives none. Vectors so
long or large that an inner product might not fit a long are refused. The input may be any frame, also a
join, and other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitplanes import finite, shape_of
from .shared import kept

BLOCK_ROWS = 2048
QUERY_ROWS = 1024
SCALE = 256


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which inner products of rows of a and b are exact."""
    if not a.size or not b.size:
        return np.float64
    most = max(1, *(int(x) for x in (a.max(), b.max(), -a.min(), -b.min())))
    bound = most * most * a.shape[1]
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


class SortedLists:
    """A block's rows, and for each dimension their places by falling and by rising component."""

    def __init__(self, rows: np.ndarray, kind: type):
        rising = np.argsort(rows, axis=0, kind="stable").T
        self.places = np.stack([rising[:, ::-1], rising]).astype(np.int32)  # [sign, dim, depth]
        self.rows = rows.astype(kind)
        columns = self.rows.T
        self.ends = np.stack([np.take_along_axis(columns, p, 1) for p in self.places])

    def best(
        self, query: np.ndarray, k: int, own: int, ids: np.ndarray, first: int = 4
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best rows, ties to the smaller of ``ids``."""
        n = len(self.rows)
        used = np.flatnonzero(query)  # a list of a zero component adds nothing to any score
        seen = np.zeros(n, bool)
        if 0 <= own < n:
            seen[own] = True
        found = np.zeros(0, np.int64)
        scores = np.zeros(0, self.rows.dtype)
        sign = (query[used] < 0).astype(np.int64)
        depth, step = 0, first
        while True:
            upto = min(n, depth + step) if len(used) else n
            new = np.zeros(n, bool)
            if len(used):
                new[self.places[sign, used, depth:upto].ravel()] = True
            else:
                new[:] = True
            new &= ~seen
            seen |= new
            at = np.flatnonzero(new)
            found = np.concatenate([found, at])
            scores = np.concatenate([scores, self.rows[at] @ query])
            if len(found) > k:
                order = np.lexsort((ids[found], -scores))[:k]
                found, scores = found[order], scores[order]
            depth, step = upto, step * 2
            if depth >= n:
                break
            threshold = self.ends[sign, used, depth - 1] @ query[used]
            if len(found) >= k and threshold < scores.min():
                break
            if seen.all():
                break
        order = np.lexsort((ids[found], -scores))
        return found[order], scores[order]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _block(k: int):
    columns = ["query_id", "query_row", "vec_id", "row", "score"]
    schema = pa.schema([(c, pa.int64()) for c in columns])

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pandas(integer_object_nulls=True)
        found = best(rows[~rows["is_query"]], rows[rows["is_query"]])
        return pa.Table.from_pandas(found, schema, preserve_index=False)

    def best(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        candidates = candidates.sort_values(["vec_id", "row"], na_position="last")
        width = max(candidates["v"].map(len).max(), queries["v"].map(len).max())
        c, q = _matrix(candidates["v"], width), _matrix(queries["v"], width)
        kind = exact_type(c, q)
        lists = SortedLists(c, kind)
        q = q.astype(kind)
        rows = candidates["row"].to_numpy(np.int64)
        ids = np.arange(len(rows))  # sorted by id, null last, then by row
        place = {r: i for i, r in enumerate(rows.tolist())}
        parts = []
        for i, (own, id) in enumerate(zip(queries["row"].tolist(), queries["vec_id"].tolist())):
            at, scores = lists.best(q[i], k, place.get(own, -1), ids)
            parts.append((id, own, at, scores))
        many = [len(p[2]) for p in parts]
        at = np.concatenate([p[2] for p in parts])
        return pd.DataFrame(
            {
                "query_id": np.repeat([p[0] for p in parts], many),
                "query_row": np.repeat([p[1] for p in parts], many),
                "vec_id": candidates["vec_id"].to_numpy()[at],
                "row": rows[at],
                "score": np.concatenate([p[3] for p in parts]).astype(np.int64),
            }
        )

    return run


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id ``every`` divides."""

    numbered = vectors.select(
        F.col(id).cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(vector).alias("x"),
    ).where(finite(F.col("x")))
    rows = kept(numbered)
    shape = shape_of(rows, "x")
    whole = rows.select(
        "vec_id",
        "row",
        F.transform("x", lambda x: F.floor(SCALE * x.cast("double")).cast("long")).alias("v"),
    )
    is_query = F.col("vec_id") % every == 0
    n_queries = rows.where(is_query).count()
    blocks, portions = max(1, -(-shape.rows // block_rows)), max(1, -(-n_queries // query_rows))
    spread = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    candidates = (
        whole.withColumn("block", spread(blocks, "block"))
        .withColumn("portion", all_of(portions))
        .withColumn("is_query", F.lit(False))
    )
    queries = (
        whole.where(is_query)
        .withColumn("portion", spread(portions, "portion"))
        .withColumn("block", all_of(blocks))
        .withColumn("is_query", F.lit(True))
    )
    best = (
        candidates.unionByName(queries)
        .groupBy("block", "portion")
        .applyInArrow(
            _block(k), "query_id long, query_row long, vec_id long, row long, score long"
        )
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row"
    )
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
