from __future__ import annotations

from pyspark.sql import functions as F

from clickpath.operators import aggr_stat, length_histogram, step_bucket, visit_bucket
from clickpath.schemas import AGGR_STAT_COLUMNS

VISIT_EDGES = {
    0: None,
    1: "1s_3s",
    3: "1s_3s",
    4: "4s_6s",
    6: "4s_6s",
    7: "7s_9s",
    9: "7s_9s",
    10: "10s_30s",
    30: "10s_30s",
    31: "30s_60s",
    60: "30s_60s",
    61: "1m_3m",
    180: "1m_3m",
    181: "3m_10m",
    600: "3m_10m",
    601: "10m_30m",
    1800: "10m_30m",
    1801: "30m",
}
STEP_EDGES = {1: "1_3", 3: "1_3", 4: "4_6", 6: "4_6", 7: "7_9", 9: "7_9", 10: "10_30", 30: "10_30", 31: "30_60", 60: "30_60", 61: "60"}


def _lengths(spark):
    steps = list(STEP_EDGES)
    rows = [(v, steps[i % len(steps)]) for i, v in enumerate(VISIT_EDGES)]
    return spark.createDataFrame(rows, "visit_length long, step_length long")


def test_bucket_edges(spark):
    df = _lengths(spark)
    got = {r[0]: r[1] for r in df.select("visit_length", visit_bucket()).collect()}
    assert got == VISIT_EDGES
    sdf = spark.createDataFrame([(k,) for k in STEP_EDGES] + [(0,)], "step_length long")
    got = {r[0]: r[1] for r in sdf.select("step_length", step_bucket()).collect()}
    assert got == {**STEP_EDGES, 0: None}


def test_histogram_counts_cover_all_but_zero_length(spark):
    df = _lengths(spark)
    h = {r.bucket: (r.sessions, r.ratio) for r in length_histogram(df, "visit").collect()}
    assert len(h) == 9
    assert sum(n for n, _ in h.values()) + 1 == df.count()  # the 0 s session is in no bucket
    assert h["1s_3s"] == (2, 0.11)
    s = {r.bucket: r.sessions for r in length_histogram(df, "step").collect()}
    assert sum(s.values()) == df.count()


def test_aggr_stat_row(spark):
    df = _lengths(spark)
    r = aggr_stat(df).first()
    assert list(r.asDict().keys()) == AGGR_STAT_COLUMNS
    assert r.session_count == 18
    # 3m_10m has its own counter (2 of 18 sessions)
    assert r.visit_length_3m_10m_ratio == 0.11 and r.visit_length_1m_3m_ratio == 0.11
    assert r.visit_length_30m_ratio == 0.06


def test_aggr_stat_empty_input_gives_nulls(spark):
    df = _lengths(spark).where(F.lit(False))
    r = aggr_stat(df).first()
    assert r.session_count == 0
    assert all(r[c] is None for c in AGGR_STAT_COLUMNS[1:])


def test_counters_merge_like_the_accumulator(spark):
    from clickpath.operators import merge_counters, session_counters, stat_from_counters
    from clickpath.plans.catalog import _full
    from tests.conftest import SF01

    full = _full(spark, SF01)
    early = full.where(F.col("start_time") < F.lit("2024-01-15").cast("timestamp_ntz"))
    late = full.where(F.col("start_time") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    merged = merge_counters(session_counters(early), session_counters(late))
    whole = session_counters(full)
    assert tuple(merged.first()) == tuple(whole.first())
    assert tuple(stat_from_counters(merged).first()) == tuple(aggr_stat(full).first())
    # an empty batch merges as zero
    empty = session_counters(full.where(F.lit(False)))
    assert tuple(merge_counters(whole, empty).first()) == tuple(whole.first())
