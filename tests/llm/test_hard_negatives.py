import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.hard_negatives import Best, Search, Tree, mine_hard_negatives, spanning_tree, window_of

SCHEMA = "vec_id bigint, embedding array<float>, label int, Score string, block int, v string"


def brute(rows, is_anchor, positives=5, negatives=5, least=80, most=100, scale=256):
    use = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        use.append((i, [math.floor(scale * float(np.float32(x))) for x in vector], label))
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    anchors = {}
    for i, v, label in sorted(use, key=lambda x: (x[2], x[1])):
        if i is not None and is_anchor(i):
            anchors.setdefault(i, (v, label))
    out = []
    for anchor, (a, own) in anchors.items():
        scored = [(sum(x * y for x, y in zip(a, v)), i, label) for i, v, label in use if i != anchor]
        near = sorted([s[:2] for s in scored if s[2] == own], key=rank)[:positives]
        for p, who in near:
            hard = sorted([s[:2] for s in scored if s[2] != own and least * p <= 100 * s[0] <= most * p], key=rank)[:negatives]
            out += [(anchor, who, k + 1, i, p, s) for k, (s, i) in enumerate(hard)]
    return collections.Counter(out)


def clustered(n, seed, labels=4, width=16, noise=0.2, hot=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    label = np.where(rng.random(n) < hot, 0, rng.integers(0, labels, n))
    return [(i, [float(x) for x in centres[k % labels] + noise * rng.normal(size=width)], int(k)) for i, k in enumerate(label)]


def run(spark, rows, is_anchor, **settings):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    return collections.Counter(tuple(r) for r in mine_hard_negatives(df, is_anchor, **settings).collect())


@pytest.mark.parametrize("settings", [{}, {"block": 4, "blocks_a_pass": 2}, {"positives": 2, "negatives": 9, "least": 10, "most": 300}])
def test_equals_all_scores(spark, settings):
    rows = clustered(700, 3, noise=1.2)
    limits = {k: v for k, v in settings.items() if "block" not in k}
    expected = brute(rows, lambda i: i % 20 == 0, **limits)
    assert run(spark, rows, F.col("vec_id") % 20 == 0, **settings) == expected and expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 5, labels=2, noise=1.0)
    rows += [
        (100, None, 1), (101, [1.0] * 16, None), (102, [nan] * 16, 1), (103, [inf] + [0.0] * 15, 1), (104, [None] + [0.5] * 15, 1),
        (105, [], 0), (110, [0.5], 0), (120, [0.25] * 20, 1), (None, [0.5] * 16, 0), (None, [0.5] * 16, 1), (None, None, None),
        (7, [0.5] * 16, 1), (7, [0.5] * 16, 1), (10, rows[10][1], rows[10][2]), (130, [0.0] * 16, 1),
    ]
    assert run(spark, rows, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)
    assert run(spark, [], F.col("vec_id") % 10 == 0) == {}
    assert run(spark, rows, F.col("vec_id") == -1) == {}


def test_large_components(spark):
    rows = clustered(80, 6)
    rows = [(i, [x * 2.0**15 for x in v], k) for i, v, k in rows]
    assert run(spark, rows, F.col("vec_id") % 8 == 0) == brute(rows, lambda i: i % 8 == 0)
    # A score beyond 64 bits cannot be given; such rows take no part.
    assert run(spark, [*rows, (800, [1e30] * 16, 0)], F.col("vec_id") % 8 == 0) == brute(rows, lambda i: i % 8 == 0)


def tree_of(vectors, labels):
    parents, edges, order = spanning_tree(vectors)
    return Tree(0, np.arange(len(vectors)), labels, vectors, parents, edges, order)


def test_spanning_tree_is_least_and_in_order():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (40, 3))
    parents, edges, order = spanning_tree(vectors)
    assert sorted(order) == list(range(40)) and (parents == -1).sum() == 1
    seen = set()
    for node in order:
        assert parents[node] in seen or parents[node] == -1
        seen.add(node)
    joined, total = {0}, 0.0
    far = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(axis=2))
    while len(joined) < 40:
        length, node = min((far[a, b], b) for a in joined for b in range(40) if b not in joined)
        total += length
        joined.add(node)
    assert abs(edges.sum() - total) < 1e-6


def test_bounds_spare_scores_and_miss_none():
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(200, 8)) * 20 + np.repeat(rng.normal(size=(4, 8)) * 300, 50, axis=0)).astype(np.int64)
    x = np.concatenate([vectors + rng.integers(-9, 9, vectors.shape), rng.integers(-400, 400, (300, 8))])
    tree = tree_of(vectors, np.zeros(200, int))
    search = Search(tree, x, np.zeros(len(x), int), np.arange(len(x)))
    whole = x @ vectors.T
    for node, rows, scores in search.walk(lambda node: [(700_000, 720_000)], lambda node: np.ones(len(x), bool)):
        inside = np.flatnonzero((whole[:, node] >= 700_000) & (whole[:, node] <= 720_000))
        assert rows.tolist() == inside.tolist() and scores.tolist() == whole[inside, node].tolist()
    assert search.met == 200 * 500 and search.scored < search.met / 2


def test_best_keeps_ties_by_id():
    best = Best(1, 3)
    best.add(0, np.array([5, 7, 5, 5]), np.array([9, 4, 2, 3]))
    assert best.least(0) == 5 and best.ids[0].tolist() == [4, 2, 3]
    best.add(0, np.array([5] * 20), np.arange(20))
    assert best.ids[0].tolist() == [4, 0, 1]
    assert window_of(7, 80, 100) == (6, 7) and window_of(-10, 80, 100) == (-8, -10)
