"""Operator 1 against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from clickpath.llm.decontaminate import ItemAutomaton, contamination_report, find_contamination, remove_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=13):
    windows = []
    for item_id, text in items:
        w = words(text)
        k = min(n, len(w))
        windows += [(item_id, w[i : i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item_id)
        ids = sorted(str(i) for i in found - {None})
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables():
    rng = random.Random(2)
    vocabulary = ["w%d" % i for i in range(6)] + ["é", "ß9"]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [(i, " ".join(prose(rng.choice([13, 14, 30, 5, 3])))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (None, "only an unnamed item of thirteen words is here to be found now ok"), (3, items[3][1]), (3, "Zebra yak")]
    items += [(30, items[0][1].upper())]
    docs = [(1, None), (2, ""), (3, "--"), (4, "zebra, YAK!"), (5, items[0][1]), (5, items[0][1]), (None, "x " + items[1][1])]
    docs += [(40 + i, " ".join(prose(200))) for i in range(10)]
    docs += [(60, " ".join(prose(3000)) + " " + items[2][1].replace(" ", "--")), (61, items[-4][1]), (62, "nothing of it")]
    return docs, items


@pytest.mark.parametrize("block_words", [1_000_000, 40, 13])
def test_report_matches_brute_force(spark, corpus, block_words):
    docs, items = tables()
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as hits")
    if block_words == 1_000_000:
        got = [tuple(r) for r in contamination_report(corpus(docs), benchmark).collect()]
        assert sorted(got, key=str) == brute(docs, items)
        return
    found = find_contamination(corpus(docs), benchmark, block_words=block_words).collect()
    got = sorted(((r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), len(r["items"])) for r in found), key=str)
    assert got == sorted((x[:4] for x in brute(docs, items)), key=str)


def test_empty_tables(spark, corpus):
    docs, items = tables()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert contamination_report(corpus(docs).where("doc_id < 0"), benchmark).collect() == []
    clean = contamination_report(corpus(docs), benchmark.where("item_id < 0")).collect()
    assert {r.n_hit for r in clean} == {0} and len(clean) == len(docs)


def test_spans_are_cut(spark, corpus):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    docs = corpus([(1, "Before: " + item.title() + ", after."), (2, "Untouched – text"), (3, None)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = find_contamination(docs, benchmark, keep_text=True)
    assert {r.doc_id: r.text for r in remove_spans(found).collect()} == {1: "Before: , after.", 2: "Untouched – text", 3: None}
    assert {r.doc_id: r.text for r in remove_spans(found, min_span=14).collect()}[1].startswith("Before: Alpha")


def test_longest_match():
    a = ItemAutomaton([("1", [b"a", b"b", b"c", b"a", b"b"])], 3)
    hit, items, longest = a.scan([b"x", b"b", b"c", b"a", b"x"])
    assert hit.tolist() == [False, True, True, True, False] and items == {0} and longest == 3
