"""Exact top-k inner products against all products."""

import math

import numpy as np
import pytest

from loglode.llm import cover_tree
from loglode.llm.cover_tree import Best, CoverTree, nearest, search

TABLE = "vec_id long, embedding array<float>"


def brute(rows, top=5, every=50):
    """(query_id, rank, vec_id, score), every row compared with every query."""
    usable = [
        (i, vec, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, (vec, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, query, q in usable:
        if query is None or query % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), vec is None, vec) for j, vec, v in usable if j != i]
        scored = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]
        out += [(query, k + 1, vec, -score) for k, (score, _, vec) in enumerate(scored)]
    return sorted(out, key=str)


def found(frame, **options):
    return sorted((tuple(r) for r in nearest(frame, **options).collect()), key=str)


@pytest.fixture(scope="module")
def crowded():
    """Clusters, one vector that a third of the rows have, one that a third almost have."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(12, 6))
    rows = [points[i % 12] + rng.normal(size=6) * 0.05 for i in range(700)]
    rows += [points[0]] * 700 + [points[1] + rng.normal(size=6) * 1e-3 for _ in range(700)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(x) for x in rows[at]]) for i, at in enumerate(order)]


def test_crowded(spark, crowded, monkeypatch):
    frame = spark.createDataFrame(crowded, TABLE).repartition(4)
    want = brute(crowded)
    assert found(frame) == want
    # Many cells and shards, short trees, several copies of each shard.
    monkeypatch.setattr(cover_tree, "CELL_ROWS", 100)
    monkeypatch.setattr(cover_tree, "TREE", 64)
    monkeypatch.setattr(cover_tree, "GROUP", 16)
    monkeypatch.setattr(cover_tree, "SLICE", 20)
    assert found(frame) == want


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 0.5]), (50, None), (100, [float("nan"), 1.0])]
    rows += [(150, [float("inf"), 1.0]), (200, [None, 1.0]), (250, []), (None, [3.0, 3.0]), (None, [3.0, 3.0])]
    rows += [(300, [1.0, 2.0, 9.0]), (3, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (-50, [0.001, -0.001])]
    frame = spark.createDataFrame(rows, TABLE)
    assert found(frame) == brute(rows)
    assert found(frame, top=2, every=3) == brute(rows, 2, 3)
    assert nearest(spark.createDataFrame([], TABLE)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0])], TABLE)).count() == 0
    assert nearest(spark.createDataFrame([(50, [1.0])], TABLE)).count() == 0
    clashing = frame.selectExpr("*", "1 AS v", "2 AS rid", "3 AS cell", "4 AS score")
    assert found(clashing) == brute(rows)


def test_products_beyond_a_double(spark):
    rows = [(i, [float(2**22 + i), float(3 * 2**20 - i), -9.0e6]) for i in range(60)]
    assert found(spark.createDataFrame(rows, TABLE)) == brute(rows)
    huge = spark.createDataFrame([(0, [3e38, 1.0]), (1, [3e38, 1.0])], TABLE)
    assert nearest(huge).first().score == 2**63 - 1


@pytest.mark.parametrize("width", [1, 2, 3])
def test_trees_cover_and_prune(width):
    rng = np.random.default_rng(width)
    vectors = (rng.normal(size=(4000, width)) * 1000).astype(np.int64)
    numbers = np.arange(len(vectors))
    tree = CoverTree(vectors, numbers, numbers)

    def check(node):
        inside = tree.points[node.start : node.end]
        assert np.linalg.norm(inside - node.center, axis=1).max() <= node.radius + 1e-9
        if node.kids:
            assert [kid.start for kid in node.kids] == [node.start, *[kid.end for kid in node.kids][:-1]]
            assert node.kids[-1].end == node.end
            near = 2.0 ** (math.ceil(math.log2(node.radius)) - 1)
            for i, kid in enumerate(node.kids):
                check(kid)
                others = [other.center for other in node.kids[:i]]
                assert all(np.linalg.norm(kid.center - x) > near for x in others)

    check(tree.root)
    queries = CoverTree(vectors[::50], numbers[::50], numbers[::50], leaf=4)
    best = Best(np.full(len(queries.ids), cover_tree.LOWEST), 5)
    made = []
    plain = cover_tree.products
    try:
        cover_tree.products = lambda *x: made.append(plain(*x).size) or plain(*x)
        search(queries, tree, best)
    finally:
        cover_tree.products = plain
    assert sum(made) < 0.4 * len(queries.ids) * len(vectors)
    scores = vectors[queries.rows] @ vectors.T
    scores[np.arange(len(scores)), queries.rows] = cover_tree.LOWEST
    assert np.array_equal(best.scores, np.sort(scores, axis=1)[:, ::-1][:, :5])
