"""Integer vectors as packed bit planes, scored by the method of Four Russians.

A component is a whole number in two's complement of as many bits as the largest needs. Bit b of eight
neighbouring components of a candidate makes one byte, so a candidate is (bits x groups) bytes. For a
query, each group of eight dimensions gets a table of the sums of all 256 subsets of its components.
The byte of a candidate's plane and group then names its share of that plane's inner product: the
shares of all groups are added up, and the planes, the highest first and with a negative sign, are
joined by doubling the sum and adding the next. Scores are full and exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP = 8
SCALE = 256
#: Queries and candidates that are scored together, so that sums stay near the processor.
QUERY_STEP = 64
ROW_STEP = 1024


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, usable), F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component."""
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64)


@dataclass(frozen=True)
class Shape:
    """What all vectors of a table have in common."""

    rows: int
    width: int
    most: int  # no component of the whole numbers is further from 0

    @property
    def groups(self) -> int:
        return max(1, -(-self.width // GROUP))

    @property
    def bits(self) -> int:
        return self.most.bit_length() + 1

    @property
    def bound(self) -> int:
        """No inner product is further from 0."""
        return self.most * self.most * max(1, self.width)


def shape_of(vectors: DataFrame, vector: str) -> Shape:
    """Shape of the vectors, which are all finite; fails where an inner product might not fit a long."""
    size = F.transform(vector, lambda x: F.abs(x.cast("double")))
    row = vectors.agg(
        F.count(F.lit(1)), F.max(F.size(vector)), F.max(F.coalesce(F.array_max(size), F.lit(0.0)))
    ).first()
    n, width, most = row[0], row[1] or 0, row[2] or 0.0
    # A product of 256 with the largest doubles is beyond them: compare before it is taken.
    if most > 2**62 or (int(SCALE * most) + 1) ** 2 * max(1, width) >= 2**62:
        raise ValueError(
            f"components up to {most} in {width} dimensions: inner products may not fit a long"
        )
    return Shape(n, width, int(SCALE * most) + 1)


def pack(v: np.ndarray, shape: Shape) -> np.ndarray:
    """Bytes [row, plane, group] of whole vectors [row, dimension]."""
    n = len(v)
    low = np.zeros((n, shape.groups * GROUP), np.int64)
    low[:, : v.shape[1]] = v
    planes = [np.packbits((low >> b) & 1 != 0, axis=1, bitorder="little") for b in range(shape.bits)]
    return np.stack(planes, axis=1) if n else np.zeros((0, shape.bits, shape.groups), np.uint8)


def unpack(planes: np.ndarray, shape: Shape) -> np.ndarray:
    """The whole vectors that ``pack`` was given, filled up to whole groups."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weight = 1 << np.arange(shape.bits, dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.einsum("nbd,b->nd", bits, weight)


def subset_sums(queries: np.ndarray, kind: type) -> np.ndarray:
    """Table [group, byte, query]: sums of the components that a byte's bits choose."""
    n, width = queries.shape
    table = np.zeros((width // GROUP, 256, n), kind)
    parts = queries.astype(kind).T.reshape(width // GROUP, GROUP, n)
    for j in range(GROUP):
        table[:, 1 << j : 2 << j] = table[:, : 1 << j] + parts[:, j, None]
    return table


def scores(planes: np.ndarray, queries: np.ndarray, shape: Shape) -> np.ndarray:
    """Inner products [row, query] of packed candidates and whole queries (whole groups wide)."""
    n, q = len(planes), len(queries)
    kind = np.int32 if shape.bound < 2**30 else np.int64
    out = np.empty((n, q), kind)
    index = planes.astype(np.intp)
    for low in range(0, q, QUERY_STEP):
        table = subset_sums(queries[low : low + QUERY_STEP], kind)
        for top in range(0, n, ROW_STEP):
            at = index[top : top + ROW_STEP]
            sums = np.zeros((len(at), table.shape[2]), kind)
            share = np.empty_like(sums)
            for b in reversed(range(shape.bits)):
                np.add(sums, sums, out=sums)
                add = np.subtract if b == shape.bits - 1 else np.add
                for g in range(shape.groups):
                    np.take(table[g], at[:, b, g], axis=0, out=share, mode="clip")
                    add(sums, share, out=sums)
            out[top : top + ROW_STEP, low : low + QUERY_STEP] = sums
    return out
