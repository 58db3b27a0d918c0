"""Vector search and vector codes against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake.llm import inner_products, pivot_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=300, width=8, seed=2):
    draw = random.Random(seed)
    rows = [(k, [draw.choice([0.0, draw.gauss(0, 0.5), 0.25]) for _ in range(width)], draw.choice([None, 1, 2])) for k in range(n)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    rows += [rows[n // 6], (50, rows[3][1], 1), (None, rows[7][1], None), (n + 50, rows[8][1], 2), (n + 51, rows[8][1], 2)]
    odd = [None, [None] * width, [math.nan] * width, [1.0] * (width - 1) + [math.inf], [-math.inf] + [0.0] * (width - 1)]
    return rows, rows + [(1000 + 50 * k, v, 1) for k, v in enumerate(odd)]


def framed(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    return table.withColumns({c: F.lit("clash") for c in ("row", "id", "parts", "cell", "score", "code", "far", "entry")})


def whole(vector, scale):
    return [math.floor(scale * x) for x in vector]


def brute_top(rows, k, every=50):
    found = []
    for q, (i, v, _) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(whole(v, 256), whole(w, 256), strict=False)), j is None, j)
            for c, (j, w, _) in enumerate(rows)
            if c != q
        ]
        found += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize(("cell", "strip", "k"), [(8192, 8192, 5), (40, 2, 5), (3, 3, 5), (100, 100, 400)])
def test_top_products(spark, monkeypatch, cell, strip, k):
    monkeypatch.setattr(inner_products, "CELL_ROWS", cell)
    monkeypatch.setattr(inner_products, "STRIP_ROWS", strip)
    kept, rows = vectors()
    found = inner_products.top_products(framed(spark, rows), F.col("vec_id") % 50 == 0, k=k)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_top(kept, k)


def test_top_products_of_few_ragged_or_no_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (50, [1.0], 1), (100, [], 1), (3, [0.0, 0.0, 4.0], 1)]
    found = inner_products.top_products(framed(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_top(rows, 5)
    for rows in ([], [(0, None, 1)], [(7, [1.0], 1)], [(0, [1.0], 1)]):
        assert inner_products.top_products(framed(spark, rows), F.col("vec_id") % 50 == 0).collect() == []


def test_components_beyond_exact_sums_are_refused(spark):
    rows = framed(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)])
    with pytest.raises(PySparkException, match="a component is beyond"):
        inner_products.top_products(rows, F.col("vec_id") % 50 == 0).collect()


def test_selection_keeps_ties_by_place():
    draw = np.random.default_rng(1)
    for _ in range(200):
        scores = draw.integers(0, 6, draw.integers(0, 30))
        for k in (1, 3, 40):
            want = sorted(range(len(scores)), key=lambda p: (-scores[p], p))[:k]
            assert inner_products.selected(scores, k).tolist() == want


def brute_codes(rows, entries):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, whole(r[1], 1024)))
    width = max(len(r[1]) for r in rows)
    length = -(-width // 4)
    cut = np.array([whole(r[1], 1024) + [0] * (4 * length - len(r[1])) for r in rows]).reshape(len(rows), 4, length)
    books = [cut[:entries, p].copy() for p in range(4)]

    def assigned():
        for p in range(4):
            squares = ((cut[:, p, None, :] - books[p][None]) ** 2).sum(2)
            yield squares.argmin(1), squares.min(1)

    for _ in range(4):
        for p, (index, _) in enumerate(list(assigned())):
            for e in set(index.tolist()):
                books[p][e] = np.floor_divide(cut[index == e, p].sum(0), (index == e).sum())
    both = list(assigned())
    codes = ["".join(f"{both[p][0][k]:02x}" for p in range(4)) for k in range(len(rows))]
    return [(r[0], r[2], codes[k], int(sum(both[p][1][k] for p in range(4)))) for k, r in enumerate(rows)], np.stack(books)


@pytest.mark.parametrize(("n", "width", "entries"), [(300, 8, 256), (300, 8, 20), (30, 8, 256), (200, 6, 9)])
def test_codes(spark, monkeypatch, n, width, entries):
    monkeypatch.setattr(pivot_codes, "ENTRIES", entries)
    kept, rows = vectors(n, width)
    coded, books = pivot_codes.codes(framed(spark, rows))
    want, want_books = brute_codes(kept, entries)
    assert sorted(map(tuple, coded.collect()), key=repr) == sorted(want, key=repr)
    assert (books == want_books).all()
    assert pivot_codes.digest(books) == pivot_codes.digest(want_books)

    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    labelled = pivot_codes.with_label_errors(coded).collect()
    assert len(labelled) == len(want) and all(r.label_error == sums[r.label] for r in labelled)


def test_codes_of_one_equal_or_no_rows(spark):
    for rows in ([(5, [1.0] * 4, None)], [(k % 3, [0.5] * 5, 1) for k in range(40)], [(0, [], 1), (1, [2.0], 1)]):
        coded, books = pivot_codes.codes(framed(spark, rows))
        want, want_books = brute_codes(rows, 256)
        assert sorted(map(tuple, coded.collect()), key=repr) == sorted(want, key=repr) and (books == want_books).all()
    for rows in ([], [(1, None, 1)]):
        coded, books = pivot_codes.codes(framed(spark, rows))
        assert pivot_codes.with_label_errors(coded).collect() == [] and books.size == 0


def test_pivots_prune_and_lose_nothing():
    """Far groups of parts are never measured against each other; ties go to the lower index."""
    draw = np.random.default_rng(3)
    middles = draw.integers(-5000, 5000, (16, 4))
    entries = np.repeat(middles, 16, 0) + draw.integers(-3, 4, (256, 4))
    entries[40] = entries[7]
    parts = entries[draw.integers(0, 256, 500)] + draw.integers(-2, 3, (500, 4))
    pivots = pivot_codes._spread(entries, 8)
    index, best = pivot_codes.nearest(parts, pivot_codes._distances(parts, pivots), entries, pivots)
    squares = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (index == squares.argmin(1)).all() and (best == squares.min(1)).all()
