"""The corpus pipeline: every stage against brute force on its own input."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from clickpath.llm import mixing, personal_data
from clickpath.llm.catalog import QUERIES
from clickpath.llm.oracles import ORACLE_SQL
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_mixing import many_texts, plain_topics, text_hashes
from tests.llm.test_models import late_toxic_rows, toxic_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(9)
    rows, labels = toxic_rows(400)
    item = " ".join(rng.choice("abcdefgh") * 3 for _ in range(40))
    rows += [(1000, None), (1001, ""), (None, "no id a@b.cd"), (1002, "see " + item + " end"), (1003, "mail a@b.cd or 10.0.0.1")]
    rows += [(1100 + i, rows[3][1] + " tail") for i in range(5)] + [(1200, rows[7][1])]
    own = " ".join(rng.choice("ijklmn") * 4 + rng.choice("op") for _ in range(60))
    rows += [(1300, own)] * 3 + [(None, own), (None, rows[9][1]), (None, "a row of its own without id"), (None, "a row of its own without id")]
    corpus(rows, extra=False).select(*COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "1 as quality").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, dict(labels), [(1, item)]


def test_stages_do_what_they_say(spark, folder):
    d, rows, toxic, items = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, d)
        after = [(r.doc_id, r.text) for r in out.collect()]
        if name != "mixing":
            assert out.columns == COLUMNS
        ids = lambda x: sorted((i for i, _ in x), key=str)
        if name == "toxicity":
            gone = set(ids(before)) - set(ids(after))
            bad = {i for i, t in toxic.items() if t}
            assert len(gone - bad) <= 2 and len(bad - gone) <= 0.1 * len(bad)
        elif name == "near_duplicates":
            numbered = [(n, t) for n, (_, t) in enumerate(before)]
            groups: dict = {}
            for n, _, g in brute_groups(numbered, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY_PERCENT):
                groups.setdefault(g, []).append(before[n][0])
            first = [min(own, key=lambda i: (i is None, i)) for own in groups.values()]  # one row of each group
            assert ids(after) == sorted(first, key=str)
            assert ids(after).count(1300) == 1 and sum(i is None for i in ids(after)) == 2
        elif name == "decontamination":
            clean = [x[0] for x in brute_contamination(before, items) if not x[-1]]
            assert ids(after) == sorted(clean, key=str) and 1002 not in clean
        elif name == "personal_data":
            assert ids(after) == ids(before)
            texts = dict(after)
            assert texts[1003] == "mail <email> or <ip>" and texts[1000] is None
            assert not any(personal_data.base_matches(t or "") for _, t in after)
        else:
            assert set(ids(after)) <= set(ids(before)) and 0 < len(after) < len(before)
        path = f"{d}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)


def test_near_duplicates_of_rows_with_own_ids(spark, folder):
    """Ids that name their rows stand for themselves: the smallest of each group stays."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("doc_id is not null and doc_id <> 1300")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert corpus_pipeline._ids_name_rows(docs) and not corpus_pipeline._ids_name_rows(docs.union(docs.limit(1)))
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, folder[0]).collect())
    groups = brute_groups(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILARITY_PERCENT)
    assert kept == sorted(i for i, _, g in groups if i == g) and len(kept) < len(rows)


def test_run_returns_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.columns[:5] == COLUMNS
    kept = [(r.doc_id, r.text) for r in out.collect()]
    given = [r[0] for r in folder[1]]
    assert 0 < len(kept) < len(given) and {i for i, _ in kept} <= set(given)
    assert all(not personal_data.base_matches(t or "") for _, t in kept) and 1002 not in {i for i, _ in kept}
    texts = [t for _, t in kept if t and t.strip()]
    assert len(set(texts)) == len(texts)


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("doc_id < 0")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder[0])
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0, name


def test_catalog_has_all_operators():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_mixing_stage_fits_topics_to_all_texts(spark, corpus):
    rows = many_texts()
    docs = corpus(rows, extra=False)
    nearest = plain_topics(rows, text_hashes(docs), mixing.TOPICS)[2]
    want = {row: f"={k}" for row, k in zip(rows, nearest.tolist(), strict=True)}
    got = {(r.doc_id, r.text): r.topic for r in corpus_pipeline.mix_sources(spark, docs, "").collect()}
    assert len(got) > 500 and got == {row: want[row] for row in got}


def test_toxicity_stage_learns_from_all_labels(spark, corpus, tmp_path):
    rows, truth = late_toxic_rows(spark)
    spark.createDataFrame(list(truth.items()), "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, corpus(rows, extra=False), str(tmp_path)).collect()}
    assert got == {i for i, toxic in truth.items() if not toxic}


def test_python_workers_give_memory_back():
    helper = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "helpers", "worker_memory.py")
    proc = subprocess.run([sys.executable, helper], capture_output=True, text=True, timeout=900, check=False)
    assert proc.returncode == 0, proc.stderr[-3000:]
    held = int(proc.stdout.split("largest ")[1])
    assert held < 100  # a worker with the libraries holds about 60; with what its tasks had freed, 140
