"""Operator 11 against exact fractions and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from clickpath.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as vec", "1 as slot", "2 as n", "'y' as whitened", "3 as value", "4 as component")


def exact_covariance(x):
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_report_matches_exact_fractions(spark, scale):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + 2) * scale
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [rows[3], (None, [0.5] * 5), (3, [1.0, 2.0, 3.0, 4.0, -5.0])]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, [1.0]), (105, []), (106, [1e30] * 5)]
    got = whitening.whitening_report(table(spark, rows + bad).repartition(5)).collect()
    assert len(got) == 5 * len(rows) and {r.n for r in got} == {len(rows)}
    x = [[math.floor(1024 * Fraction(c)) + 100000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    cov = np.array([[float(c) for c in r] for r in exact_covariance(x)])
    values, vectors = np.linalg.eigh(cov)
    want = {}
    for (i, v), r in zip(rows, x, strict=True):
        centred = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(r, sums, strict=True)])
        want.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True))), []).append(centred)
    sign = {}
    for r in got:
        assert 1 <= r.component <= 5 and r.identity_error < 1e-6
        e = values[5 - r.component]
        assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-9)
        centred = want[(r.vec_id, int(r.deviation_exact))][0]
        value = centred @ vectors[:, 5 - r.component] / math.sqrt(e)
        assert abs(r.whitened) == pytest.approx(abs(value), abs=1e-7)
        if abs(value) > 1e-6:
            assert sign.setdefault(r.component, np.sign(value * r.whitened)) == np.sign(value * r.whitened)
        assert r.deviation == (int(r.deviation_exact) if int(r.deviation_exact) < 1 << 63 else None)


def test_covariance_comes_from_pair_sums():
    z = np.array([[3, -1, 4], [1, 5, -9], [2, 6, 5], [-5, 3, 5]])
    squares = whitening.polarised_squares(z).tolist()
    assert len(squares) == 6 and squares[3] == sum((a + b) ** 2 for a, b, _ in z.tolist())
    got = whitening.covariance(4, z.sum(0).tolist(), [int(s) for s in squares])
    assert np.allclose(got, np.cov(z.T, bias=True), rtol=1e-14)


@pytest.mark.parametrize("total", [0, 1, -1, 5 << 31, -(5 << 31), (1 << 150) + 12345, -(1 << 150) - 7, (1 << 62) - 1, -(1 << 62)])
def test_limbs_are_exact(total):
    rows = whitening._limb_rows([total]).to_pylist()
    assert sum(r["value"] << (32 * r["limb"]) for r in rows) == total


def test_without_variance_or_rows(spark):
    same = whitening.whitening_report(table(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect()
    assert len(same) == 8 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error is None for r in same)
    flat = whitening.whitening_report(table(spark, [(i, [float(i), 2.0]) for i in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-9
    assert [r.component for r in whitening.whitening_report(table(spark, [(1, [3.0])])).collect()] == [1]
    assert whitening.whitening_report(table(spark, [])).collect() == []
    assert whitening.whitening_report(table(spark, [(1, None), (2, []), (3, [None])])).collect() == []


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(5)
    got = whitening.whitening_report(table(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 12)))])).collect()
    assert sorted({r.component for r in got}) == list(range(1, 9)) and len(got) == 400
    w = np.array([r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component))]).reshape(50, 8)
    assert np.abs(w.T @ w / 50 - np.eye(8)).max() < 1e-9
