"""Tries over distinct parts, codebooks and codes against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import vectorcodes
from tallyloom.llm.vectorcodes import Trie, distinct


@pytest.mark.parametrize("together", [1, 3, 4096])
@pytest.mark.parametrize("span,width,n", [(2, 4, 300), (40, 4, 500), (9, 1, 50), (500, 3, 1), (3, 11, 400)])
def test_leaves_take_the_nearest_entry(span, width, n, together):
    r = np.random.default_rng(n)
    parts, _, _ = distinct(r.integers(-span, span + 1, (n, width)), span)
    entries = r.integers(-span, span + 1, (17, width))
    entries[9] = entries[4]  # equal entries: the lower index
    chosen, distance = Trie(parts).nearest(entries, together)
    all_of = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (distance == all_of.min(axis=1)).all() and (chosen == all_of.argmin(axis=1)).all()


def test_what_parts_share_is_summed_once():
    parts = np.array([(5, 5, x, y) for x in range(10) for y in range(10)])
    trie = Trie(parts)
    assert [len(s) for s in trie.starts] == [1, 1, 10, 100]


@pytest.mark.parametrize("most", [3, 10**12])
def test_distinct_parts_in_order(most):
    v = np.random.default_rng(1).integers(-3, 4, (200, 3))
    parts, of, n = distinct(v, most)
    assert (parts[of] == v).all() and n.sum() == 200
    assert list(map(tuple, parts.tolist())) == sorted(set(map(tuple, v.tolist())))


def brute(rows, n_parts, k, rounds):
    """Codebooks [position, entry, component] and (id, label, code, error) in plain loops."""
    ok = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = -(-max((len(v) for _, _, v in ok), default=0) // n_parts)
    cut = lambda v: [
        (v + [0] * (n_parts * width))[p * width : (p + 1) * width] for p in range(n_parts)
    ]
    vectors = [(i, label, cut(v)) for i, label, v in ok]
    start = sorted(zip(ok, vectors), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[0][2]))[:k]
    books = [[list(v[p]) for _, (_, _, v) in start] for p in range(n_parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda part, book: min((far(part, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(n_parts):
            of = [best(v[p], books[p])[1] for _, _, v in vectors]
            for j in range(len(books[p])):
                mine = [v[p] for (_, _, v), o in zip(vectors, of) if o == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    coded = []
    for i, label, v in vectors:
        found = [best(v[p], books[p]) for p in range(n_parts)]
        coded.append((i, label, bytes(j for _, j in found), sum(d for d, _ in found)))
    return books, coded


SCHEMA = "vec_id long, label int, embedding array<double>"


def check(spark, rows, n_parts=4, k=5, rounds=2, schema=SCHEMA, more=()):
    df = spark.createDataFrame(rows, schema)
    df = df.select("*", *[F.lit(n).alias(n) for n in more]).repartition(3)
    coded, books = vectorcodes.compress(df, n_parts, k, rounds)
    want_books, want = brute(rows, n_parts, k, rounds)
    assert books.entries.tolist() == want_books
    text = ",".join(str(x) for p in want_books for e in p for x in e)
    assert books.digest() == hashlib.sha256(text.encode()).hexdigest()
    by_label = {}
    for _, label, _, error in want:
        by_label[label] = by_label.get(label, 0) + error
    want = [(i, label, code, error, by_label[label]) for i, label, code, error in want]
    got = [(r.id, r.label, bytes(r.code), r.error, r.label_error) for r in coded.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return coded, books


def vectors(n, width=12, seed=0, size=0.125):
    r = np.random.default_rng(seed)
    return [(i, i % 3, [float(x) for x in r.normal(0, size, width)]) for i in range(n)]


def test_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "PORTION", 400)
    rows = vectors(200)
    rows[20:60] = [(i, 1, rows[20][2]) for i in range(20, 60)]
    rows += [(3, 2, rows[70][2]), (3, 2, rows[70][2]), (None, None, rows[71][2]), (None, 0, rows[72][2])]
    rows += [(-1, None, None), (-2, 1, [0.1, None] * 6), (-3, 1, [float("nan")] * 12)]
    rows += [(-4, 1, [float("-inf")] + [0.0] * 11), (-5, None, rows[73][2])]
    clash = "id x code error position entry component total n salt label_error".split()
    check(spark, rows, more=clash)
    check(spark, rows, rounds=0)
    check(spark, rows, n_parts=12, k=9)


def test_lengths_that_do_not_divide_and_few_rows(spark):
    rows = [(i, label, v[: 1 + i % 11]) for i, label, v in vectors(60, seed=3)]
    check(spark, rows, n_parts=4, k=64)
    check(spark, vectors(3), n_parts=16, k=8)


def test_large_components(spark):
    check(spark, vectors(80, seed=4, size=3e4))
    for size in (1e30, 1.7e308):
        with pytest.raises(ValueError, match="may not fit"):
            vectorcodes.fit(spark.createDataFrame([(0, 1, [size, 1.0])], SCHEMA))


@pytest.mark.parametrize("rows", [[], [(0, 1, None)], [(0, None, [])], [(0, 1, [0.5])]])
def test_little_or_nothing(spark, rows):
    if rows and rows[0][2] == []:  # a vector of no components has codes of no distance
        coded, _ = vectorcodes.compress(spark.createDataFrame(rows, SCHEMA), 4, 5)
        assert [tuple(r) for r in coded.collect()] == [(0, None, b"\0\0\0\0", 0, 0)]
    else:
        check(spark, rows)


def test_many_labels_are_joined_in_shares(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "LABELS_SENT", 5)
    rows = [(i, None if i % 7 == 0 else 0 if i % 2 else i, v) for i, _, v in vectors(120, seed=6)]
    check(spark, rows)


def test_codes_stand_for_their_entries(spark):
    coded, books = check(spark, vectors(50, seed=7))
    entries = books.entries
    for r in vectorcodes.decode(coded, books).collect():
        want = np.concatenate([entries[p, j] for p, j in enumerate(r.code)]) / 256
        assert r.decoded == want.tolist()
