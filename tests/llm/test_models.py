"""Operators 3, 4, 6 and 7: held-out accuracy, recall and marginals, and edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import hash_forest, mixing, quality, toxicity
from clickpath.llm.common import held_out

SF01 = "/root/testdata/sf0.01"
EDGE = [(9001, None), (9002, ""), (9003, " \n "), (9004, "one"), (9005, "word " * 30000), (9006, "dup dup"), (9006, "dup dup"), (None, "no id")]


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values, inverse, counts = np.unique(np.array(scores)[order], return_inverse=True, return_counts=True)
    ranks[order] = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    labels = np.array(labels)
    good = labels.sum()
    return (ranks[labels == 1].sum() - good * (good + 1) / 2) / (good * (len(labels) - good))


def toxic_rows(n=600):
    rng = random.Random(8)
    bad, words = ["scum", "moron", "Pathetic"], ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, corpus):
    rows, labels = toxic_rows()
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (777777, 1), (0, 0)], "doc_id long, toxic int").withColumn("label", F.lit(5))
    got = toxicity.toxicity_report(corpus(rows + EDGE), table).collect()
    assert len(got) == len(rows) + len(EDGE)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert len({r.score for r in got if r.doc_id in (9001, 9002, 9003)}) == 1
    assert len({r.score for r in got if r.doc_id == 9006}) == 1
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id > 9000)


def test_labels_of_held_out_rows_are_not_used(spark, corpus):
    rows, labels = toxic_rows(200)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = table.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity_report(corpus(rows), t).collect()) for t in (table, flipped)]
    assert scores[0] == scores[1]


def late_toxic_rows(spark):
    """26,000 rows, all labelled; toxic ones only after the first 16,000 of those that training may use, by hash of the id."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(300)]
    order = [r[0] for r in spark.range(26000).withColumnRenamed("id", "doc_id").where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    assert len(order) > 17000
    toxic = {*order[16000:], *(i for i in range(26000) if i % 40 == 0)} - {*order[:16000]}
    rows = [(i, " ".join([*rng.choices(words, k=rng.randint(4, 9)), *(["scum"] if i in toxic else [])])) for i in range(26000)]
    return rows, {i: int(i in toxic) for i in range(26000)}


def test_toxicity_learns_from_all_labels(spark, corpus, monkeypatch):
    rows, truth = late_toxic_rows(spark)
    docs, table = corpus(rows).cache(), spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    settings = toxicity.Ftrl(epochs=2, l1=1.0)
    model = toxicity.fit(docs, table, settings=settings)
    shards: dict = {}
    h = F.xxhash64("doc_id", F.lit(1))
    own = docs.where(~held_out()).select("doc_id", "text", h.alias("h")).orderBy("doc_id").collect()
    count = -(-len(own) // toxicity.SHARD_ROWS)
    for r in own:
        shards.setdefault(r.h % count, []).append((r, truth[r.doc_id]))
    total, bias, margin = {}, 0.0, []
    for found in shards.values():
        found = [(toxicity.distinct_features(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text)]))[0], y) for r, y in found if (r.h >> 20) % 5]
        keys, weights, b = toxicity.train([found[i] for i in np.random.default_rng(0).permutation(len(found))], settings)
        bias += b / count
        for k, w in zip(keys.tolist(), weights.tolist(), strict=True):
            total[k] = total.get(k, 0.0) + w / count
    assert len(shards) == count == 5
    assert model.keys.tolist() == sorted(total)
    assert np.allclose(model.weights, [total[k] for k in sorted(total)]) and np.isclose(model.bias, bias)
    for r, y in (x for found in shards.values() for x in found):
        if (r.h >> 20) % 5 == 0:
            feature = toxicity.distinct_features(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text)]))[0]
            margin.append((bias + sum(total.get(f, 0.0) for f in feature.tolist()), y))
    assert len(margin) > 3000
    x, y = np.array(margin).T
    p = toxicity.logistic(model.stretch * x + model.shift)  # at the best curve the gradient is zero
    assert np.allclose([(p - y) @ x + 1e-2 * (model.stretch - 1), (p - y).sum() + 1e-2 * model.shift], 0, atol=1e-5)
    monkeypatch.setattr(toxicity, "BROADCAST_LABELS", 0)
    joined = toxicity.fit(docs, table, settings=settings)
    assert np.array_equal(joined.keys, model.keys) and np.allclose(joined.weights, model.weights) and np.isclose(joined.shift, model.shift)


@pytest.mark.parametrize("report", [toxicity.toxicity_report, quality.quality_report])
def test_without_labels_scores_are_half(spark, corpus, report):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    got = report(corpus(EDGE), none).collect()
    assert len(got) == len(EDGE) and {r.score for r in got} == {0.5}
    assert report(corpus(EDGE).where("doc_id < 0"), none).collect() == []


def test_quality_on_held_out_rows(spark, corpus):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    extra = corpus(EDGE, extra=False).select(*docs.columns)
    got = quality.quality_report(docs.unionByName(extra).withColumn("stats", F.lit(1)), labels).collect()
    assert len(got) == docs.count() + len(EDGE)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert auc([r.score for r in held], [truth[r.doc_id] for r in held]) > 0.95
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.93 * len(held)


def test_isotonic_pools_violations():
    raw, chance = quality.pooled([0.1, 0.2, 0.3, 0.4], [0, 2, 1, 4], [4, 4, 4, 4])
    assert np.all(np.diff(chance) > 0) and np.allclose(chance, [0, 3 / 8, 1]) and np.allclose(raw, [0.1, 0.25, 0.4])


def test_neighbours_recall_and_order(spark, corpus):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 24)) * rng.uniform(0.5, 2, size=(900, 1))
    vectors[300:340] = vectors[40]  # more copies than neighbours wanted
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [1.0] * 23 + [None]), (2080, [1.0, 2.0]), (2100, []), (None, [1.0] * 24), (2120, [float("inf")] * 24)]
    table = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>").selectExpr("*", "1 as key", "2 as score", "3 as block")
    got: dict = {}
    for r in hash_forest.nearest(table, 20, F.col("vec_id") % 20 == 0, block_rows=200, query_rows=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 900, 20))
    found = 0
    for q, answers in got.items():
        scores = (vectors * vectors[q]).sum(1)
        scores[q] = -np.inf
        best = set(np.lexsort((np.arange(900), -scores))[:20].tolist())
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, 21))
        assert [(-s, v) for _, v, s in answers] == sorted((-s, v) for _, v, s in answers)
        assert all(abs(s - scores[v]) < 1e-12 for _, v, s in answers)
        found += len(best & {a[1] for a in answers})
    assert found >= 0.9 * 20 * len(got)


def test_neighbours_of_few_and_no_rows(spark, corpus):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, -1.0]), (7, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in hash_forest.nearest(table, 20, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 7, 1.0), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 7, 0.0)]
    assert hash_forest.nearest(table.where("vec_id < 0"), 20, F.lit(True)).collect() == []


def mix_rows():
    rng = random.Random(6)
    rows = [(i, " ".join("w%s" % rng.choice("abcdefgh") * 5 for _ in range(rng.randint(5, 60))), "s0" if i % 3 == 0 else f"s{rng.randint(1, 5)}", rng.choice(["en", "en", "de", "fr"])) for i in range(900)]
    return rows + [(5000, None, "s1", "en"), (5001, "", "s1", "en"), (5002, "alpha beta", None, None), (5003, "alpha", "odd", "en"), (None, "alpha beta gamma", "s1", "de")]


def test_raked_weights_meet_the_marginals(spark, corpus):
    assert mixing.mixing_report(corpus(mix_rows())).count() == len(mix_rows())
    # values that occur in one cell only (nulls, an odd source) can't meet two marginals at once
    docs = corpus(mix_rows()[:900])
    got = mixing.mixing_report(docs).collect()
    tokens = np.array([r.n_tokens for r in got], float)
    weight = np.array([r.weight for r in got])
    for column in ("source", "lang", "topic"):
        values = [r[column] for r in got]
        now, mass = {}, {}
        for v, t, w in zip(values, tokens, weight, strict=True):
            now[v] = now.get(v, 0) + t * w
            mass[v] = mass.get(v, 0) + t
        total = sum(m**0.5 for m in mass.values())
        for v, m in mass.items():
            assert now[v] / tokens.sum() == pytest.approx(m**0.5 / total, abs=1e-4)
    probability = np.array([r.probability for r in got])
    assert (tokens * probability).sum() == pytest.approx(0.5 * tokens.sum(), rel=0.01)
    kept = np.array([r.kept for r in got])
    assert abs((tokens * kept).sum() - 0.5 * tokens.sum()) < 0.08 * tokens.sum()
    again = {r.doc_id: r.kept for r in mixing.mixing_report(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.kept for r in got}


def test_given_targets_and_empty_tables(spark, corpus):
    docs = corpus(mix_rows())
    described = mixing.describe(docs, keep_rows=False)
    sources = spark.createDataFrame([("s0", 0.2), ("s1", 0.8)], "source string, target double")
    fit = mixing.fit(described, languages={"en": 0.7, "de": 0.3}, sources=sources)
    rows = mixing.draw(described, fit).groupBy("mix_source", "mix_lang").agg(F.sum(F.col("mix_tokens") * F.col("mix_weight")).alias("m")).collect()
    total = sum(r.m for r in rows)
    share = lambda column, value: sum(r.m for r in rows if r[column] == value) / total
    assert share("mix_source", "=s1") == pytest.approx(0.8, abs=1e-3) and share("mix_lang", "=en") == pytest.approx(0.7, abs=1e-3)
    assert share("mix_lang", "=fr") == 0 and share("mix_source", "=s2") == 0
    assert mixing.mixing_report(docs.where("doc_id < 0")).collect() == []
    assert mixing.sample(docs.where("doc_id < 0")).collect() == []
