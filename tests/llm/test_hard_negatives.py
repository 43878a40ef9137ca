"""Operator 13 against brute force, and its tree's invariants."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import cover_tree, hard_negatives
from clickpath.llm.cover_tree import CoverTree


def brute(rows, anchors, positives=5, negatives=3, scale=256, shares=(50, 95)):
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        key = ([math.floor(scale * c) for c in v], label)
        own[i] = min(own.get(i, key), key)
    out = []
    for a in anchors:
        if a not in own:
            continue
        v, label = own[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, (w, other) in own.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fit = [(i, -t) for t, i, same in scored if not same and shares[0] * -s <= 100 * -t <= shares[1] * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(fit[:negatives])]
    return sorted(out)


def clustered(n=700, d=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, d)) * 2
    v = (centres[rng.integers(0, 9, n)] + rng.normal(size=(n, d)) * 0.4) * rng.uniform(0.2, 2, (n, 1))
    v[200:420] = v[199]  # one vector holds a third of the rows
    v[450:470] = np.round(v[450:470])
    return [(i, x.tolist(), int(rng.integers(0, 4))) for i, x in enumerate(v)]


BAD = [(5000, None, 1), (5010, [0.1] * 12, None), (5020, [float("nan")] + [0.0] * 11, 1), (5030, [None] + [0.0] * 11, 1), (None, [1.0] * 12, 1), (5040, [1.0, 2.0], 1), (5050, [float("inf")] * 12, 2)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as cell", "2 as block", "'x' as vec", "3 as part", "4 as score", "5 as rank", "6 as window")


def mined(spark, rows, **options):
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), **options).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("block_rows, anchor_rows", [(8192, 8192), (60, 20)])
def test_matches_brute_force(spark, corpus, block_rows, anchor_rows):
    rows = clustered() + BAD + [(10, [0.5] * 12, 0), (20, [0.0] * 12, 1)]
    want = brute([r for r in rows if r[0] != 5040], range(0, 6000, 10))
    assert len(want) > 200
    assert mined(spark, rows, block_rows=block_rows, anchor_rows=anchor_rows) == want


def test_large_entries_use_integer_products(spark, corpus):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=4) * 3e5).tolist(), i % 3) for i in range(90)]
    assert mined(spark, rows, block_rows=40) == brute(rows, range(0, 90, 10))
    with pytest.raises(ValueError):
        mined(spark, [(i, [1e9, 1e9], 0) for i in range(20)])


def test_other_counts_and_shares(spark, corpus):
    rows = clustered(300, seed=5)
    got = mined(spark, rows, positives=2, negatives=6, shares=(10, 100), block_rows=100)
    assert got == brute(rows, range(0, 300, 10), 2, 6, shares=(10, 100))


def test_few_and_no_rows(spark, corpus):
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2), (3, [0.2, 0.0], 2)]
    assert mined(spark, rows) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(spark, rows[1:]) == []
    assert hard_negatives.mining_report(frame(spark, rows).where("vec_id < 0")).collect() == []


def test_report_moves_labels(spark, corpus):
    rows = [(i, v, label) for i, v, label in clustered(400, seed=7)]
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    got = hard_negatives.mining_report(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(moved, range(0, 400, 50))


def test_tree_covers_and_separates():
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(500, 6)) * 100).astype(np.int64)
    bound2 = float((vectors**2).sum(1).max()) + 1
    tree = CoverTree.from_bytes(CoverTree.build(np.arange(500), np.zeros(500, np.int64), vectors, bound2, leaf=8).to_bytes())
    assert sorted(tree.ids.tolist()) == list(range(500)) and (tree.vectors == vectors[tree.ids]).all()
    for node in range(len(tree.centre)):
        own = tree.points[tree.start[node] : tree.end[node]]
        apart = cover_tree.distances(own, tree.points[tree.centre[node]])
        assert apart.max() == pytest.approx(tree.radius[node])
        first, many = tree.child[node], tree.children[node]
        if many:
            assert tree.start[first] == tree.start[node] and tree.end[first + many - 1] == tree.end[node]
            centres = tree.points[tree.centre[first : first + many]]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))[~np.eye(many, dtype=bool)]
            assert gaps.min() >= tree.radius[first : first + many].max() - 1e-9
    queries = (rng.normal(size=(40, 6)) * 100).astype(np.int64)
    low, high = cover_tree.product_bounds(tree.points[tree.centre], tree.radius, queries.astype(float), bound2)
    for node in range(len(tree.centre)):
        products = tree.vectors[tree.start[node] : tree.end[node]].astype(np.int64) @ queries.T
        assert (products >= low[node]).all() and (products <= high[node]).all()


def test_tree_skips_what_is_outside():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 500
    vectors = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) * 5).astype(np.int64)
    tree = CoverTree.build(np.arange(4000), np.zeros(4000, np.int64), vectors, float((vectors**2).sum(1).max()) + 1)
    looked = []
    class Counting(np.ndarray):
        def __getitem__(self, key):
            looked.append(len(key))
            return super().__getitem__(key)
    tree.exact = tree.exact.view(Counting)
    low = np.full((1, 1), cover_tree.LOWEST)
    q, w, ids, scores = tree.search(np.array([0]), np.array([0]), vectors[:1], low, np.full((1, 1), cover_tree.HIGHEST), 5, True)
    assert sum(looked) < 1500
    products = vectors @ vectors[0]
    products[0] = cover_tree.LOWEST
    assert sorted(scores.tolist()) == sorted(np.sort(products)[-5:].tolist())
