"""Operator 5 against brute force."""

from __future__ import annotations

import random
import re
import time
from pathlib import Path

import pytest

from clickpath.llm import components as components_module
from clickpath.llm import jaccard_join
from clickpath.llm.common import materialize
from clickpath.llm.components import components
from clickpath.llm.jaccard_join import near_duplicates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=4, percent=85):
    sets = []
    for _, text in rows:
        w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def near_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a"), (6, "a b c d"), (7, "É b c d"), (8, "é b c d"), (None, "a b"), (9, "q " * 200), (10, "q " * 300)]
    passage = prose(40)
    for g in range(6):
        base = prose(rng.choice([12, 40, 150, 400]))
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((100 * g + 50 + len(rows) % 40, " ".join(own)))
    rows += [(1000 + i, " ".join(prose(25) + passage)) for i in range(20)]
    rows += [(2000, rows[20][1]), (2000, rows[40][1]), (2001, " ".join(prose(5000)))]
    seen, out = set(), []
    for r in rows:
        if r[0] is None or r[0] >= 2000 or r[0] not in seen:
            out.append(r)
            seen.add(r[0])
    return out


@pytest.mark.parametrize(("block_grams", "chunk_bytes", "percent", "n"), [(4_000_000, 4 << 20, 85, 4), (300, 3000, 85, 4), (4_000_000, 2000, 80, 5)])
def test_components_match_brute_force(spark, corpus, block_grams, chunk_bytes, percent, n):
    rows = near_rows()
    found = near_duplicates(corpus(rows), n, percent, block_grams, chunk_bytes).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, n, percent)


def test_split_block_with_two_large_groups(spark, corpus):
    """Near copies in a second large group of a split block are linked, but not all pairs of them."""
    rng = random.Random(4)
    groups = [[f"{c}{rng.randrange(10**6)}" for _ in range(60)] for c in "xy"]
    rows, edited = [], []
    for i in range(100):
        words = list(groups[i >= 60])
        words[rng.randrange(60)] = f"z{i}"
        edited.append(" ".join(words))
        rows.append((7, i % 4, 4, i, 57, edited[-1]))
    corpus([(1, "x")])
    split = spark.createDataFrame(rows, "block long, part int, parts int, node long, grams long, text string")
    own = split.groupBy("block", "part").applyInArrow(jaccard_join._own_products(4, 80), jaccard_join._EDGES)
    links = [(r.a, r.b) for r in jaccard_join._split_links(split, own, 4, 80, 1000).collect()]
    assert all((a < 60) == (b < 60) for a, b in links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: component for i, _, component in brute(list(enumerate(edited)), 4, 80)}
    assert len(links) < 4 * len(rows)


def test_empty_table(spark, corpus):
    assert near_duplicates(corpus([(1, "x")]).where("doc_id < 0")).collect() == []


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(7, 7), (None, 3)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in parent}


def copied_rows():
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        texts += [" ".join(words), " ".join([*words, "more"])]
    rows = [(100 * copy + i, text) for copy in range(8) for i, text in enumerate(texts)]
    return rng.sample(rows, len(rows)), len(texts)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_finished_steps_leave_the_disk(spark, corpus, monkeypatch):
    """When the signatures begin, the files of the n-gram exchange and of the texts' are gone."""
    left, send = [], jaccard_join._send_signatures

    def watched(*args):
        own = shuffle_files(spark) - before
        for _ in range(50):  # Spark removes them in a thread of its own
            left[:] = [len(own & shuffle_files(spark))]
            if not left[0]:
                break
            time.sleep(0.2)
        return send(*args)

    rows, _ = copied_rows()
    docs = corpus(rows)
    monkeypatch.setattr(jaccard_join, "_send_signatures", watched)
    tables = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before, kept = shuffle_files(spark), set(tables.glob("sets-*"))
    found = jaccard_join.near_duplicates(docs)
    # the two joins of classes, of ids only, come between
    assert left[0] <= 2 * 8 * 2
    assert len({r.component_id for r in found.collect()}) == 12
    assert set(tables.glob("sets-*")) == kept


def test_copies_are_signed_once(spark, corpus, monkeypatch):
    """Of equal sets in different chunks only the representative's text goes on."""
    texts, chunks = [], jaccard_join.from_chunks

    def watched(docs, fn, schema, *args):
        if schema == jaccard_join._SIGNED:
            texts.extend(r.doc_id for r in docs.collect())
        return chunks(docs, fn, schema, *args)

    rows, different = copied_rows()
    monkeypatch.setattr(jaccard_join, "from_chunks", watched)
    found = near_duplicates(materialize(spark, corpus(rows).repartition(6)), chunk_bytes=2000)
    assert sorted(texts) == list(range(different))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str) == brute(rows)


def test_minima_are_dealt_by_the_number_of_edges(spark, monkeypatch):
    """Not over all shuffle partitions: these are many where the texts are large."""
    dealt, keep = [], components_module.materialize

    def watched(session, df, spread=False):
        out = keep(session, df, spread)
        if "m" in df.columns:
            dealt.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(components_module, "materialize", watched)
    monkeypatch.setattr(components_module, "PARTITION_EDGES", 10)
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    assert {r.component for r in components(edges).collect()} == {0}
    assert dealt and max(dealt) <= 3 + 1
