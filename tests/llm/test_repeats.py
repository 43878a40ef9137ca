"""Operators 8 and 10 against brute force, on edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from clickpath.llm import suffix_dedup, suffixes
from clickpath.llm.chunks import Chunk
from clickpath.llm.repeats import remove_repeats, repeats_report
from clickpath.llm.suffix_dedup import remove_repeated_bytes, repeated_windows, suffix_report

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, n=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        words = WORDS.findall(rows[i][1] or "")
        gone = [False] * len(words)
        for s in range(len(words) - n + 1):
            window = tuple(words[s : s + n])
            if window in seen:
                gone[s : s + n] = [True] * n
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((rows[i][0], len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, n=400):
    counts = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, t in texts:
        for s in range(len(t) - n + 1):
            counts[t[s : s + n]] = counts.get(t[s : s + n], 0) + 1
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - n + 1):
            if counts[t[s : s + n]] > 1:
                gone[s : s + n] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def edge_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage = prose(90)
    rows = [
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, "one"),
        (9, prose(19)),
        (10, passage),
        (11, prose(30) + " " + passage + "  " + prose(10)),
        (12, prose(5) + "\n" + passage[: len(passage) // 2] + " x " + passage[len(passage) // 2 :]),
        (13, "same " * 300),
        (14, "ab" * 700),
        (15, passage),
        (15, passage),
        (15, prose(25)),
        (None, passage),
        (None, prose(40)),
        (16, prose(6000) + " " + passage),
        (17, "ä" * 500),
        (18, "ä" * 399),
    ]
    return rows + [(100 + i, prose(12) + " " + passage + " " + prose(12)) for i in range(25)]


@pytest.mark.parametrize("chunk_bytes", [700, 4 << 20])
def test_word_repeats_match_brute_force(spark, corpus, chunk_bytes):
    rows = edge_rows()
    found = remove_repeats(corpus(rows), chunk_bytes=chunk_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found), key=str)
    if chunk_bytes > 1000:
        assert got == brute_words(rows)
    else:  # rows that repeat an id may be ordered by chunk: compare the others
        unique = lambda out: [x for x in out if x[0] not in (None, 15)]
        assert unique(got) == unique(brute_words(rows))
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


@pytest.mark.parametrize("chunk_bytes", [700, 2 << 20])
def test_byte_repeats_match_brute_force(spark, corpus, chunk_bytes):
    rows = edge_rows()
    found = remove_repeated_bytes(corpus(rows), chunk_bytes=chunk_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
    assert got == brute_bytes(rows)


def hot_rows():
    """A short line and a longer passage, each in many documents with contexts of their own."""
    rng = random.Random(12)
    prose = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    line, passage = prose(250), prose(450)
    rows = [(1000 + i, prose(500) + line + prose(500)) for i in range(40)]
    rows += [(2000 + i, prose(rng.randint(0, 300)) + passage + prose(rng.randint(0, 300))) for i in range(40)]
    return rows + [(3000 + i, rows[50][1]) for i in range(4)] + [(None, rows[2][1])]


@pytest.mark.parametrize("chunk_bytes", [700, 2 << 20])
def test_hot_anchors_match_brute_force(spark, corpus, chunk_bytes):
    rows = edge_rows() + hot_rows()
    found = remove_repeated_bytes(corpus(rows), chunk_bytes=chunk_bytes, sort_bytes=8000).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
    assert got == brute_bytes(rows)


@pytest.mark.parametrize("sort_bytes", [800, 3200])
def test_hot_cores_match_brute_force(spark, corpus, sort_bytes):
    """So few texts may meet that windows descend to the narrowest cells; copies keep their contexts repeated."""
    rows = edge_rows() + hot_rows() + [(4000 + i, t) for i, (_, t) in enumerate(hot_rows()[:60])]
    found = remove_repeated_bytes(corpus(rows), chunk_bytes=5000, sort_bytes=sort_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found), key=str)
    assert got == brute_bytes(rows)


def test_cells_share_their_cores():
    n, buckets = 400, 4
    assert suffix_dedup.cell_widths(n) == [67, 17, 5, 2, 1] and suffix_dedup.cell_widths(3) == [1]
    chunk = Chunk(0, pa.array(range(40)), pa.array([t for _, t in hot_rows()[:40]]))
    r = suffix_dedup._Runs(chunk, n, buckets)
    raw = chunk.data.tobytes()
    for width in suffix_dedup.cell_widths(n):
        c = suffix_dedup._Cells(r, np.arange(len(r.first)), width, n, buckets)
        assert c.count.sum() == r.count.sum() and c.count.max() <= width
        cores: dict = {}
        for first, count, anchor, key in zip(c.first.tolist(), c.count.tolist(), c.anchor.tolist(), c.key.tolist(), strict=True):
            start = anchor - (anchor - first) // width * width
            assert first + count - 1 <= start and start + n - width + 1 <= first + n
            cores.setdefault(key, set()).add(raw[start : start + n - width + 1])
        assert all(len(v) == 1 for v in cores.values())


def test_texts_of_a_hot_anchor_do_not_meet():
    """What a bucket gets of an anchor with differing contexts is bounded and spread."""
    n, buckets, sort_bytes = 400, 16, 8000
    chunks = [Chunk(i, pa.array([a]), pa.array([b])) for i, (a, b) in enumerate(hot_rows()[:40])]
    sent = pa.Table.from_pylist([x for c in chunks for x in suffix_dedup._send_anchors(n, buckets)(c)], schema=suffix_dedup._SENT_ARROW)
    match = suffix_dedup._match_anchors(sort_bytes // (2 * n))
    at = lambda t, b: t.filter(pa.array(np.array(t.column("bucket")) == b))
    hits = [x for b in set(sent.column("bucket").to_pylist()) for x in match(at(sent, b))]
    held = np.zeros(buckets, np.int64)
    for c in chunks:
        own = pa.Table.from_pylist([x for x in hits if x["chunk"] == c.number], schema=suffix_dedup._ANSWER_ARROW)
        for x in suffix_dedup._send_spans(n, buckets)(c, own):
            held[x["bucket"]] += len(x["texts"])
    assert held.min() > 0 and held.max() < 2 * held.mean()


def test_anchors_spread_over_the_buckets():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(20000)) for _ in range(10)]
    r = suffix_dedup._Runs(Chunk(0, pa.array(range(10)), pa.array(texts)), 400, 16)
    held = np.bincount((r.key >> np.uint64(40)).astype(int), minlength=16)
    assert held.min() > 0 and held.max() < 2 * held.mean()


def test_empty_tables(spark, corpus):
    empty = corpus([(1, "x")]).where("doc_id < 0")
    assert repeats_report(empty).collect() == []
    assert suffix_report(empty).collect() == []


def test_suffix_sort_matches_plain_sort():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 900).astype(np.uint8)
    at = rng.permutation(800)[:300]
    length = rng.integers(0, 100, 300)
    raw = data.tobytes()
    order, common = suffixes.sort(data, at, length, True)
    texts = [raw[at[i] : at[i] + length[i]] for i in order]
    assert texts == sorted(texts)
    for k in range(1, len(texts)):
        a, b = texts[k - 1], texts[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[k] == n
    back, _ = suffixes.sort(data, at + 100, length, False)
    texts = [raw[at[i] + 100 - length[i] : at[i] + 100][::-1] for i in back]
    assert texts == sorted(texts)


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    """All hashes equal: the verification finds it and the bytes decide."""
    monkeypatch.setattr(suffixes.PrefixHash, "segments", lambda self, a, b: np.zeros(len(a), np.uint64))
    data = np.frombuffer(b"banana_bandana", np.uint8)
    at, length = np.arange(14), 14 - np.arange(14)
    order, common = suffixes.sort(data, at, length, True)
    assert [b"banana_bandana"[i:] for i in order] == sorted(b"banana_bandana"[i:] for i in range(14))
    assert common.max() == 3


def test_windows_need_both_sides():
    """Texts that agree left of the anchor with one text and right of it with another hold no repeat."""
    anchor = b"#" * 4  # n = 12: anchors of 4 bytes
    texts = [(8, 1, b"llllllll" + anchor), (0, 1, anchor + b"rrrrrrrr")]
    flags = repeated_windows(texts, [1, 1], 12)
    assert [f.any() for f in flags] == [False, False]
    both = [(4, 1, b"llll" + anchor + b"rrrr"), (4, 1, b"llll" + anchor + b"rrrs")]
    assert [f.any() for f in repeated_windows(both, [1, 1], 12)] == [False, False]
