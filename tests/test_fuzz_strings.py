"""Seeded fuzz of the k=v helpers against Python models of Java's split rules."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from clickpath.functions import kv_get, kv_set, pad_two, trim_comma


def java_split(s: str, sep: str) -> list[str]:
    """``String.split`` with a literal one-character separator and limit 0."""
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_get(s, field):
    if s is None:
        return None
    for frag in java_split(s, "|"):
        p = java_split(frag, "=")
        if len(p) == 2 and p[0] == field:
            return p[1]
    return None


def model_set(s, field, value):
    if s is None:
        return None
    frags = java_split(s, "|")
    for i, f in enumerate(frags):
        if f.split("=")[0] == field:
            frags[i] = f"{field}={value}"
            break
    return "|".join(frags)


def _strings(n, alphabet, max_len, seed):
    rnd = random.Random(seed)
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]
    return vals + [None]


def test_kv_get_and_set_match_java_rules(spark):
    vals = _strings(1500, "ab=|x", 9, 11)
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    fields = ["a", "b", ""]
    cols = [kv_get("s", f).alias(f"g{i}") for i, f in enumerate(fields)]
    cols += [kv_set("s", f, "Z").alias(f"s{i}") for i, f in enumerate(fields)]
    rows = df.select("s", *cols).collect()
    for r in rows:
        for i, f in enumerate(fields):
            assert r[f"g{i}"] == model_get(r.s, f), (r.s, f)
            assert r[f"s{i}"] == model_set(r.s, f, "Z"), (r.s, f)


def test_trim_and_pad_match_models(spark):
    vals = _strings(800, ",a1", 5, 5)
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select("s", trim_comma("s").alias("t"), pad_two("s").alias("p")).collect()
    for r in rows:
        if r.s is None:
            assert r.t is None and r.p is None
            continue
        want = r.s
        if want.startswith(","):
            want = want[1:]
        if want.endswith(",") and r.s.endswith(",") and len(r.s) > 1:
            want = want[:-1]
        assert r.t == want, r.s
        assert r.p == (r.s if len(r.s) == 2 else "0" + r.s)
    assert df.where(F.col("s").isNull()).count() == 1
