"""The forest of operator 6: prefixes, depths and candidates (recall is in test_models)."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import hash_forest
from clickpath.llm.hash_forest import Forest


def forest(n=300, d=6, trees=8, bits=10, seed=1):
    v = np.random.default_rng(seed).normal(size=(n, d))
    return v, Forest.from_bytes(Forest.build(v, float(np.sqrt((v * v).sum(1).max())), trees, bits).to_bytes())


def strings_of(f, vectors):
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    return hash_forest._strings(np.concatenate((unit, np.zeros((len(unit), 1))), 1), f.trees, f.bits, f.seed)


def test_candidates_are_the_shared_prefixes():
    v, f = forest()
    assert (np.diff(f.strings, axis=1) >= 0).all() and (np.sort(f.order, axis=1) == np.arange(300)).all()
    own = np.empty((300, f.trees), np.int64)
    own[f.order, np.arange(f.trees)[:, None]] = f.strings
    asked = strings_of(f, v[:7])
    depth = np.array([0, 1, 3, 5, 8, 10, 2])
    seen = f._candidates(asked, depth)
    for q, x in enumerate(depth):
        want = ((own >> (f.bits - x)) == (asked[q] >> (f.bits - x))[None, :]).any(1)
        assert (seen[q] == want).all()
    first = f._first_depth(asked, 40)
    for q, x in enumerate(first):
        size = lambda x: ((own >> (f.bits - x)) == (asked[q] >> (f.bits - x))[None, :]).sum()  # noqa: B023, E731
        assert size(x) >= 40 and (x == f.bits or size(x + 1) < 40)


@pytest.mark.parametrize("cosine", [0.95, 0.6, 0.3, 0.0, -0.4])
def test_last_depth_keeps_the_miss_probability(cosine):
    _, f = forest(trees=64, bits=24)
    (x,) = f._last_depth(np.array([cosine]), 0.05)
    missed = lambda x: (1 - (1 - np.arccos(cosine) / np.pi) ** x) ** 64
    assert missed(x) <= 0.05 and (x == 24 or missed(x + 1) > 0.05)
    assert f._last_depth(np.array([-np.inf]), 0.05)[0] == 0


def test_dense_and_gathered_products_agree(monkeypatch):
    v, f = forest()
    bound = np.full(20, 1.0)
    found = []
    for share in (0.0, 2.0):
        monkeypatch.setattr(hash_forest, "DENSE", share)
        found.append([x.tolist() for x in f.search(v[:20], 5, bound)])
    assert found[0] == found[1] and (np.array(found[0][2]) >= 1.0 - 1e-6).all()


def test_tied_and_repeated_vectors(spark, corpus):
    same = [(i, [1.0, 0.0, 0.0]) for i in range(100)] + [(100 + i, [0.5, 0.5, float(i)]) for i in range(30)]
    table = spark.createDataFrame(same, "vec_id long, embedding array<double>")
    got = {}
    for r in hash_forest.nearest(table, 4, F.col("vec_id") % 50 == 0, block_rows=10, query_rows=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got[0]) == [(1, 1), (2, 2), (3, 3), (4, 4)] and sorted(got[50]) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    assert [v for _, v in sorted(got[100])] == [0, 1, 2, 3]
