"""Operator 7 against a plain iterative proportional fitting of the same cells."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickpath.llm import mixing


def plain_ipf(cells, given, temper=0.5, rounds=100, tolerance=1e-6):
    """Weights per (source, lang, topic) cell; targets of a marginal as a dict, or tempered shares."""
    cells = {k: t for k, t in cells.items() if t}
    total = sum(cells.values())
    targets, factors = [], []
    for m in range(3):
        mass = {}
        for k, t in cells.items():
            mass[k[m]] = mass.get(k[m], 0) + t
        raw = {v: x**temper for v, x in mass.items()} if given[m] is None else {v: given[m].get(v, 0.0) for v in mass}
        targets.append({v: x / sum(raw.values()) for v, x in raw.items()})
        factors.append(dict.fromkeys(mass, 1.0))
    for _ in range(rounds):
        error = 0.0
        for m in range(3):  # sources, languages, topics; the sources' gap does not count
            now = dict.fromkeys(factors[m], 0.0)
            for k, t in cells.items():
                now[k[m]] += t / total * np.prod([factors[o][k[o]] for o in range(3) if o != m])
            for v in now:
                error = max(error, abs(now[v] * factors[m][v] - targets[m][v])) if m else 0.0
                factors[m][v] = targets[m][v] / now[v] if now[v] > 0 else 0.0
        if error <= tolerance:
            break
    return {k: float(np.prod([factors[m][k[m]] for m in range(3)])) for k in cells}, error


def described(spark, rows):
    """Rows (doc_id, source, lang, topic, tokens) as ``describe`` makes them."""
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, mix_tokens long")
    return df.select("*", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")).alias(m) for c, m in zip(("source", "lang", "topic"), mixing.MARGINALS, strict=True)])


def cells_of(rows):
    cells = {}
    for _, source, lang, topic, tokens in rows:
        cells[(source, lang, topic)] = cells.get((source, lang, topic), 0) + tokens
    return cells


def weights_of(fit):
    plain = lambda v: None if v == "null" else v[1:]
    return {tuple(plain(r[m]) for m in mixing.MARGINALS): r.weight for r in fit.cells.collect()}


def random_rows(n, sources, langs, topics, seed=4):
    rng = random.Random(seed)
    pick = lambda name, k: rng.choice([None, *(f"{name}{rng.randint(0, k)}" for _ in range(9))])
    return [(i, pick("s", sources), pick("l", langs), pick("t", topics), rng.choice([0, 1, 7, 50, 900])) for i in range(n)]


def assert_same(got, want):
    assert set(want) <= set(got)
    for k, w in want.items():
        assert got[k] == pytest.approx(w, rel=1e-6, abs=1e-12), k
    assert all(w == 1.0 for k, w in got.items() if k not in want)


def test_tempered_shares_match_plain_ipf(spark, corpus):
    rows = random_rows(3000, 6, 4, 3)
    fit = mixing.fit(described(spark, rows))
    want, error = plain_ipf(cells_of(rows), [None] * 3)
    assert error <= 1e-6 and fit.error <= 1e-6
    assert_same(weights_of(fit), want)


def test_factor_tables_do_the_same(spark, corpus):
    rows = random_rows(400, 4, 3, 2)
    targets = {"l0": 3.0, "l1": 1.0, "l2": 1.0, None: 1.0}
    fit = mixing.fit(described(spark, rows), languages=targets, rounds=2, tolerance=0.0, pairs=3)
    want, error = plain_ipf(cells_of(rows), [None, targets, None], rounds=2, tolerance=0.0)
    assert_same(weights_of(fit), want)
    assert fit.error == pytest.approx(error, rel=1e-6)


def test_three_hundred_languages_with_targets(spark, corpus):
    rows = random_rows(20000, 3, 299, 2, seed=9)
    languages = {f"l{i}": float(i + 1) for i in range(300)} | {None: 5.0}
    topics = {"t0": 2.0, "t1": 1.0, "t2": 1.0}  # null topics go
    given = spark.createDataFrame([(k, v) for k, v in languages.items()], "language string, share double")
    fit = mixing.fit(described(spark, rows), languages=given, topics=topics)
    cells = cells_of(rows)
    want, error = plain_ipf(cells, [None, languages, topics])
    assert error <= 1e-6 and fit.error <= 1e-6
    got = weights_of(fit)
    assert_same(got, want)
    total = sum(got[k] * t for k, t in cells.items())
    for i in (0, 150, 256, 257, 299):  # the rarest target and those beyond any round number
        mass = sum(got[k] * t for k, t in cells.items() if k[1] == f"l{i}")
        assert mass > 0 and mass / total == pytest.approx((i + 1) / sum(languages.values()), rel=1e-3)


def test_targets_that_contradict_each_other_end(spark, corpus):
    rows = [(1, "a", "x", "t", 10), (2, "b", "y", "t", 10)]
    fit = mixing.fit(described(spark, rows), sources={"a": 0.9, "b": 0.1}, languages={"x": 0.1, "y": 0.9})
    assert fit.error > 0.5 and set(weights_of(fit)) == {("a", "x", "t"), ("b", "y", "t")}


def test_topic_from_a_column(spark, corpus):
    docs = spark.createDataFrame([(i, "word " * (i % 7), "s", "en", None if i % 5 == 4 else f"subject {i % 5}") for i in range(200)], "doc_id long, text string, source string, lang string, subject string")
    got = mixing.mixing_report(docs.selectExpr("*", "'x' as mix_topic", "1 as mix_named"), "subject", topics={"subject 1": 0.75, "subject 2": 0.25}).collect()
    assert {r.topic for r in got} == {None, *(f"subject {i}" for i in range(4))}
    mass = lambda t: sum(r.n_tokens * r.weight for r in got if r.topic == t)
    assert mass("subject 1") == pytest.approx(3 * mass("subject 2"), rel=1e-4) and mass("subject 0") == mass(None) == 0
    assert all(not r.kept for r in got if r.topic == "subject 0" and r.n_tokens)


def test_fitted_topics_follow_vocabulary(spark, corpus):
    rng = random.Random(3)
    spoken = [["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(40)] for _ in range(4)]
    rows = [(i, " ".join(rng.choice(spoken[i % 4]) for _ in range(rng.randint(30, 90)))) for i in range(400)] + [(900, None), (901, "a b c"), (None, "")]
    docs = corpus(rows)
    model = mixing.fit_topics(docs, topics=4)
    got = {r.doc_id: r.mix_topic for r in mixing.describe(docs, model, keep_rows=False).collect()}
    assert len({got[i] for i in range(4)}) == 4 and all(got[i] == got[i % 4] for i in range(400))
    assert got[900] == got[901] == "=3"
    again = mixing.fit_topics(docs.repartition(7), topics=4)
    assert np.array_equal(model.centres, again.centres)
    small = mixing.fit_topics(docs, topics=4, sample_rows=60)
    assert len(small.centres) == 4


def plain_topics(rows, hashes, topics, rounds=20):
    """Rarities, centres and topics of rows (id, text) by k-means over all of them; ``hashes`` settle ties."""
    data = [(t or "").encode() for _, t in rows]
    counts = np.concatenate([mixing._place_counts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1] for t in data])
    order = [i for i in np.argsort(hashes, kind="stable").tolist() if counts[i].any()]
    own = counts[order]
    rarity = np.log((1 + len(own)) / (1 + (own > 0).sum(0))) + 0.1
    v = np.sqrt(own) * rarity
    v /= np.sqrt((v * v).sum(1))[:, None]
    centres = v[:1]
    while len(centres) < topics:
        centres = np.concatenate((centres, v[[np.round(v @ centres.T, 9).max(1).argmin()]]))
    for _ in range(rounds):
        nearest = np.round(v @ centres.T, 9).argmax(1)
        centres = np.array([v[nearest == k].sum(0) if (nearest == k).any() else c for k, c in enumerate(centres)])
        centres /= np.sqrt((centres * centres).sum(1))[:, None]
    nearest = np.full(len(rows), topics - 1)
    nearest[order] = np.round(v @ centres.T, 9).argmax(1)
    return rarity, centres, nearest


def many_texts(seed=5):
    """5,000 rows in five vocabularies, one of them in 15 rows only; some without long words, null or repeated."""
    rng = random.Random(seed)
    spoken = [["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(30)] for _ in range(5)]
    kind = lambda i: 4 if i % 331 == 7 else i % 4
    rows = [(i, " ".join(rng.choice(spoken[kind(i)]) for _ in range(rng.randint(8, 20)))) for i in range(4900)]
    rows += [(3, rows[3][1])] * 60 + [(5000 + i, None if i % 2 else "a bc d") for i in range(37)]
    return rows + [(6000, "zebra " * 70000), (None, rows[1][1]), (None, None)]


def text_hashes(docs):
    return [r[0] for r in docs.select(F.xxhash64(F.col("doc_id").cast("string"), "text")).collect()]


def test_topics_are_fitted_to_all_texts(spark, corpus):
    rows = many_texts()
    docs = corpus(rows)
    rarity, centres, nearest = plain_topics(rows, text_hashes(docs), 6)
    model = mixing.fit_topics(docs, topics=6)
    assert np.allclose(model.rarity, rarity, rtol=1e-12)
    assert np.allclose(model.centres, centres, atol=1e-6)
    assert np.array_equal(mixing.fit_topics(docs.repartition(9), topics=6).centres, model.centres)
    got = mixing.describe(docs, model, keep_rows=False).select("doc_id", "mix_topic").collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, got), key=key) == sorted(((i, f"={k}") for (i, _), k in zip(rows, nearest.tolist(), strict=True)), key=key)


def test_no_text_has_a_long_word(spark, corpus):
    for rows in ([], [(1, None), (2, "a b")]):
        assert not mixing.fit_topics(corpus(rows)).centres.any()
        assert {r.topic for r in mixing.mixing_report(corpus(rows)).collect()} == ({mixing.TOPICS - 1} if rows else set())
