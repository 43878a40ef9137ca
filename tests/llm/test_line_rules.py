"""Operator 12 against a plain implementation of its rules."""

from __future__ import annotations

import random
import re

import pytest

from clickpath.llm import line_rules as rules

SEPARATORS = rules.SEPARATORS
SENTENCE = "[.!?,;:…。！？]"


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def brute_line(line):
    n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
    if not n:
        return None
    odd = len(re.findall(rules.ODD_MARKS, line))
    if (odd >= 2 and 100 * odd >= 20 * n) or (n >= 40 and not re.search(SENTENCE, line)):
        return "punctuation"
    separators = len(re.findall(SEPARATORS, line))
    if (n <= 12 and 2 * len(re.findall(rules.MENU_WORDS, line, re.ASCII)) >= n) or (separators >= 2 and 100 * separators >= 33 * n):
        return "navigation"
    return "boilerplate" if n <= 30 and re.search(rules.PHRASES, line) else None


def texts():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    lines = ["Home | About | Contact", "Home Menu Search", "All rights reserved.", "Licensed under the MIT License.", "GREAT!! DEAL!! NOW!!", "a$$$ b### c", "", " \t ", "x | y | z", "What?! No!!", "price $5"]
    out = []
    for _ in range(150):
        own = [sentence(rng.randint(3, 30)) for _ in range(rng.randint(1, 6))] + rng.sample(lines, rng.randint(0, 6))
        rng.shuffle(own)
        if rng.random() < 0.3:
            own += own[: rng.randint(1, 3)]
        out.append(rng.choice(["\n", "\n\n"]).join(own))
    long_line = " ".join(rng.choice(vocabulary) for _ in range(60))
    repeated = " ".join(["one two three four five six seven eight nine"] * 10)
    return out + [None, "", "\n", " \n ", "word", long_line, long_line + ".", repeated, "é" * 30, "a\r\nb\x0bc", " ".join(["w"] * 19), " ".join(f"w{i}," for i in range(20))]


@pytest.mark.parametrize("block", [rules.BLOCK_BYTES, 300])
def test_counts_rules_and_verdict(spark, corpus, block):
    rows = list(enumerate(texts())) + [(0, "again " * 30), (None, "no id. " * 25), (None, None)]
    got = rules.clean_lines(corpus(rows), block).collect()
    assert len(got) == len(rows)
    want = []
    for i, text in rows:
        base = brute_base(text)
        lines = (text or "").split("\n")
        failed = [(k, brute_line(line)) for k, line in enumerate(lines) if brute_line(line)]
        lost = sum(len(lines[k].split()) for k, _ in failed)
        cleaned = text if not failed else "\n".join(line for k, line in enumerate(lines) if k not in dict(failed))
        bad = base[0] < 20 or 100 * base[4] > 30 * base[0]
        want.append((i, *base, lost, failed, cleaned, bad, not bad and 100 * lost <= 50 * base[0]))
    have = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lost_words, [tuple(f) for f in r.failed_lines], r.text, r.base_failed, r.kept) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert {f for r in want for _, f in r[7]} == set(rules.RULES) and {r[-1] for r in want} == {True, False}


def test_one_text_longer_than_a_block(spark, corpus):
    words = [f"w{i % 50021}" for i in range(900_000)]
    line = " ".join(words[:200])
    text = "\n".join([" ".join(words) + ".", line, line, "Home | About | Contact"])
    assert len(text) > rules.BLOCK_BYTES
    (r,) = rules.quality_rules_report(corpus([(1, text)])).collect()
    assert tuple(r)[1:6] == brute_base(text) and r.n_dup_lines == 1 and r.n_lost_words == 405


def test_empty_table(spark, corpus):
    assert rules.quality_rules_report(corpus([(1, "a")]).where("doc_id < 0")).collect() == []
