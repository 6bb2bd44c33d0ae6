"""Bit planes, tables of subset sums, and hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import bitplanes, negatives


@pytest.mark.parametrize("width", [1, 7, 8, 13, 64])
@pytest.mark.parametrize("most", [1, 255, 256, 40_000])
def test_scores_are_inner_products(width, most):
    r = np.random.default_rng(width)
    v = r.integers(-most, most + 1, (150, width))
    v[0], v[1], v[2] = most, -most, 0
    shape = bitplanes.Shape(len(v), width, most)
    planes = bitplanes.pack(v, shape)
    assert planes.shape == (150, shape.bits, shape.groups)
    queries = bitplanes.unpack(planes, shape)
    assert (queries[:, :width] == v).all() and not queries[:, width:].any()
    assert (bitplanes.scores(planes, queries[:70], shape) == v @ v[:70].T).all()


def test_a_table_holds_all_subset_sums():
    q = np.arange(1, 17).reshape(1, 16) ** 2
    table = bitplanes.subset_sums(q, np.int64)
    for g in range(2):
        for byte in range(256):
            chosen = [int(q[0, 8 * g + j]) for j in range(8) if byte >> j & 1]
            assert table[g, byte, 0] == sum(chosen)


def brute(rows, every=50, n_positives=5, n_negatives=3, lower=50, upper=95):
    """The contract in plain loops; rows are (id, label, vector)."""
    ok = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    found = []
    for n, (anchor, label, a) in enumerate(ok):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(x * y for x, y in zip(a, c)), i, other)
            for m, (i, other, c) in enumerate(ok)
            if m != n
        ]
        positives = sorted((s for s in scored if s[2] == label), key=order)[:n_positives]
        for best, positive, _ in positives:
            hard = [
                s for s in scored
                if s[2] != label and lower * best <= 100 * s[0] <= upper * best
            ]
            for rank, (score, i, _) in enumerate(sorted(hard, key=order)[:n_negatives], 1):
                found.append((anchor, positive, rank, i, best, score))
    return sorted(found, key=str)


def mined(df, **how):
    columns = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    return sorted((tuple(r) for r in negatives.mine(df, **how).select(*columns).collect()), key=str)


def vectors(n, width=9, seed=0, labels=4):
    r = np.random.default_rng(seed)
    return [
        (i, int(r.integers(labels)), [float(x) for x in r.normal(0.05, 0.125, width)]) for i in range(n)
    ]


SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("blocks", [(4096, 4096), (40, 3), (7, 1)])
def test_mined_rows_equal_brute_force(spark, blocks):
    rows = vectors(230)
    rows[10:40] = [(i, 1, rows[10][2]) for i in range(10, 40)]  # copies: ties by id
    rows += [(50, 2, rows[50][2]), (50, 2, rows[50][2]), (0, 3, rows[3][2])]  # repeated ids and rows
    rows += [(None, 1, rows[60][2]), (None, 2, rows[60][2])]
    rows += [(100_000, None, rows[1][2]), (100_050, 1, None), (100_100, 1, [0.5, None] + [0.1] * 7)]
    rows += [(100_150, 1, [float("inf")] + [0.1] * 8), (100_200, 1, [float("nan")] * 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    # Positions of repeated rows differ between the two; their ids and scores do not.
    got = mined(df.repartition(5, "vec_id"), every=10, block_rows=blocks[0], anchor_rows=blocks[1])
    assert got == brute(rows, every=10) and len(got) > 100


def test_a_hot_label_and_other_bounds(spark):
    rows = [(i, 0 if i % 3 else i, v) for i, _, v in vectors(300, seed=4)]
    df = spark.createDataFrame(rows, SCHEMA)
    how = {"every": 7, "n_positives": 2, "n_negatives": 4, "lower": 20, "upper": 80}
    assert mined(df, block_rows=64, **how) == brute(rows, **how)


def test_vectors_of_different_lengths_and_clashing_columns(spark):
    rows = [(i, label, v[: 1 + i % 9]) for i, label, v in vectors(120, seed=2)]
    df = spark.createDataFrame(rows, SCHEMA)
    more = "row id x planes portion block is_anchor score rank nth anchor_row code".split()
    df = df.select("*", *[F.lit(n).alias(n) for n in more])
    assert mined(df, every=5) == brute(rows, every=5)


def test_labels_of_any_type_and_joined_input(spark):
    rows = vectors(150, seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    other = df.select("vec_id").withColumn("name", F.concat(F.lit("l"), F.col("vec_id") % 3))
    named = df.drop("label").join(other, "vec_id").withColumnRenamed("name", "label")
    want = brute([(i, f"l{i % 3}", v) for i, _, v in rows], every=10)
    assert mined(named, every=10) == want


def test_large_components(spark):
    rows = [(i, label, [x * 1e5 for x in v]) for i, label, v in vectors(90, seed=5)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(df, every=10) == brute(rows, every=10)
    for size in (1e30, 1.7e308):
        bad = spark.createDataFrame([(0, 1, [size, 1.0])], "vec_id long, label int, embedding array<double>")
        with pytest.raises(ValueError, match="may not fit a long"):
            negatives.mine(bad)


@pytest.mark.parametrize("rows", [[], [(0, 1, [0.5])], [(0, 1, []), (1, 1, []), (2, 2, [])], [(0, None, None)]])
def test_few_rows(spark, rows):
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
