"""Best-first search against all products."""

import math
import random

import numpy as np
import pytest

from millrace.llm import mtree

SCHEMA = "vec_id long, embedding array<float>, label int, row long, id long, v string, tree long"


@pytest.fixture
def vectors(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, v, 0, 7, 7, "x", 7) for i, v in rows], SCHEMA).repartition(parts)

    return make


def brute(rows, k=20, every=20):
    sound = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows
             if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q) in enumerate(sound):
        if i is None or i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(sound) if b != at)
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


def result(df, **options):
    found = mtree.top_k(df, lambda i: i % 20 == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def cloud(n, dim, seed, centers=6, spread=0.2):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, dim))
    return [(k, (middle[rng.integers(centers)] + spread * rng.normal(size=dim)).tolist()) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"tree": 60, "page": 8, "fan": 3, "block": 10}, {"tree": 100, "page": 4, "fan": 2, "pivots": 2}])
def test_equals_all_products(vectors, options):
    rows = cloud(700, 8, 1)
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # a hot vector: ties by id
    assert result(vectors(rows), **options) == brute(rows)


def test_norms_far_apart(vectors):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1) * 10 ** rng.uniform(-3, 3) for _ in range(5)]) for k in range(400)]
    assert result(vectors(rows), tree=50, page=8) == brute(rows)


def test_odd_rows(vectors):
    inf, nan = float("inf"), float("nan")
    rows = [(20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (0, [1.0, 2.0]), (100, []), (120, [1.0]), (None, [1.0, 2.0]), (None, None),
            (140, [0.5, 0.5]), (140, [0.5, 0.5]), (-20, [0.0, -1.0]), (3, [0.01, -0.01])]
    assert result(vectors(rows)) == brute(rows)


def test_huge_components_do_not_fail(vectors):
    rows = [(k, [3e38 * (-1) ** k, 1.0]) for k in range(0, 60, 4)]
    found = result(vectors(rows), tree=4, page=2)
    assert len(found) == 3 * 14 and max(r[3] for r in found) == (1 << 63) - 1


def test_few_rows_and_none(vectors):
    assert result(vectors([(0, [1.0, 2.0])])) == []
    assert result(vectors([(0, [1.0]), (1, [2.0])])) == [(0, 1, 1, 64 * 128)]
    assert result(vectors([])) == []


def test_bounds_spare_most_pages(spark, vectors):
    """With tight clusters most entries are never looked at."""
    rows = cloud(2000, 6, 3, centers=20, spread=0.02)
    space = mtree.Space(6, float(max(np.linalg.norm(np.floor(64 * np.array(v))) for _, v in rows)), 400.0)
    v = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64)
    import pyarrow as pa
    table = pa.table({"tree": pa.array([0] * len(rows)), "row": pa.array(range(len(rows))), "id": pa.array(range(len(rows))), "v": pa.array(v.tolist())})
    built = mtree._build(space, space.lifted(v[:1]), 16, 8)(table)
    assert sorted(r for n in built.to_pylist() for r in n["rows"]) == list(range(len(rows)))
    tree, seen = mtree.Tree(space, built), []
    products = mtree.Space.products
    try:
        mtree.Space.products = lambda self, q, x: (seen.append(len(q) * len(x)), products(self, q, x))[1]
        tree.best(v[:100], np.arange(100), np.full(100, mtree.LOWEST), 5)
    finally:
        mtree.Space.products = products
    assert sum(seen) < 0.35 * 100 * len(rows)
