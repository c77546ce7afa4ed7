import math
import random

import pytest

from conftest import rows_of
from tidemark.llm import metric_search
from tidemark.llm.metric_search import nearest, scaled


def plain(rows, is_query, k):
    good = []
    for vec_id, e in rows:
        if vec_id is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            good.append((vec_id, [math.floor(1024 * x) for x in e]))
    result = []
    queries = {}
    for vec_id, v in sorted(good):
        if is_query(vec_id):
            queries.setdefault(vec_id, v)
    for query_id, q in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != query_id)
        result += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(result)


def search(spark, rows, k=10, every=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string").repartition(3)
    vectors = scaled(frame)
    found = nearest(vectors, vectors.filter(f"vec_id % {every} = 0"), k)
    return rows_of(found, "query_id", "rank", "vec_id", "score")


def vectors(n, dims, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(dims)], "x") for i in range(n)]


@pytest.mark.parametrize(("n", "dims"), [(400, 8), (150, 64), (3, 4), (1, 2)])
def test_equals_all_products(spark, monkeypatch, n, dims):
    monkeypatch.setattr(metric_search, "PAGE", 16)
    monkeypatch.setattr(metric_search, "TREE_BYTES", 60 * 8 * dims)
    rows = vectors(n, dims, n)
    assert search(spark, rows) == plain([r[:2] for r in rows], lambda i: i % 5 == 0, 10)


def test_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(metric_search, "PAGE", 8)
    monkeypatch.setattr(metric_search, "BLOCK_BYTES", 3 * 8 * 4)  # several passes
    monkeypatch.setattr(metric_search, "SEEDS", 20)
    same = [0.5, -0.25, 1.0]
    rows = [(i, same, "x") for i in range(40)] + [
        (40, None, "x"), (41, [0.1, None, 2.0], "x"), (42, [0.1, math.nan, 2.0], "x"), (45, [math.inf, 0.0, 0.0], "x"),
        (None, same, "x"), (50, [0.0, 0.0, 0.0], "x"), (55, [], "x"), (60, [3.0], "x"), (61, [1.0, 2.0, 3.0, 4.0], "x"),
        (7, [9.0, 9.0, 9.0], "x"), (-5, [-1.0, -1.0, -1.0], "x"),
    ]
    assert search(spark, rows) == plain([r[:2] for r in rows], lambda i: i % 5 == 0, 10)


def test_large_components_are_exact(spark):
    rows = [(i, [x * 3e4 for x in v], "x") for i, v, _ in vectors(60, 5, 3)]
    assert search(spark, rows) == plain([r[:2] for r in rows], lambda i: i % 5 == 0, 10)


def test_pages_are_left_out():
    """Clustered vectors: the stored distances spare most products, on several levels."""
    import numpy as np

    draw = np.random.default_rng(1)
    centers = draw.integers(-9000, 9000, (40, 8))
    v = (centers[draw.integers(40, size=8000)] + draw.integers(-50, 50, (8000, 8))).astype(np.int64)
    most = float((v**2).sum(axis=1).max())
    root = metric_search._placed(v[:1], most)[0]
    row = metric_search._tree(0, root, np.arange(8000), v, most).to_pylist()[0]
    tree = metric_search._Tree(row, 8, True)
    assert (tree.children[1:] > 0).any()  # a node below the first is split too
    assert sorted(tree.ids.tolist()) == list(range(8000))
    for node in range(len(tree.radius)):  # radii cover what lies below, stored distances are right
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        for c in below:
            assert tree.parent[c] == pytest.approx(np.linalg.norm(tree.centers[c] - tree.centers[node]))
    point = np.append(v[17].astype(float), 0.0)
    query = metric_search._Query(17, point, point[:8], math.inf, 10, most)
    tree.search(query, float(np.linalg.norm(point - root)))
    products = sorted((-int(p), i) for i, p in enumerate(v @ v[17]) if i != 17)[:10]
    assert list(zip(query.scores.tolist(), query.ids.tolist())) == [(-p, i) for p, i in products]
    assert tree.products < 4000


def test_copies_of_one_vector_fill_pages():
    """Vectors that no routing object tells apart are cut into pages all the same."""
    import numpy as np

    v = np.tile(np.array([[3, 4]], np.int64), (1000, 1))
    row = metric_search._tree(0, np.array([0.0, 0.0, 5.0]), np.arange(1000), v, 25.0).to_pylist()[0]
    tree = metric_search._Tree(row, 2, True)
    assert tree.items.sum() == 1000 and tree.items.max() <= metric_search.PAGE


@pytest.mark.parametrize("seeds", [1, 9, 4096])
def test_first_limit_loses_nothing(spark, monkeypatch, seeds):
    monkeypatch.setattr(metric_search, "SEEDS", seeds)
    rows = vectors(200, 6, 11) + [(i, [0.0] * 6, "x") for i in range(200, 230)]
    assert search(spark, rows) == plain([r[:2] for r in rows], lambda i: i % 5 == 0, 10)


def test_empty_tables(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0], "x"), (2, [2.0], "x")]) == []
