from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickpath.operators import hour_counts, hour_quotas, sample_details, sample_sessions
from tests.conftest import SF01, action, make_actions


def _sessions(spark, starts):
    rows = [(f"s{i}", dt.datetime.fromisoformat(t)) for i, t in enumerate(starts)]
    return spark.createDataFrame(rows, "session_id string, start_time timestamp_ntz")


def _quota_map(df):
    return {(r.date, r.hour): r for r in df.collect()}


def test_one_day_one_hour(spark):
    s = _sessions(spark, ["2024-01-01 05:10:00"] * 7)
    q = _quota_map(hour_quotas(hour_counts(s), total=3))
    r = q[("2024-01-01", "05")]
    assert (r.sessions, r.day_sessions, r.days, r.day_quota, r.hour_quota) == (7, 7, 1, 3, 3)
    assert sample_sessions(s, total=3).count() == 3
    # the hour holds fewer sessions than its share
    assert sample_sessions(s, total=100).count() == 7


def test_uneven_hours_floor(spark):
    starts = ["2024-01-01 01:00:00"] * 6 + ["2024-01-01 02:00:00"] * 3 + ["2024-01-01 03:00:00"] * 1
    s = _sessions(spark, starts)
    q = _quota_map(hour_quotas(hour_counts(s), total=5))
    assert [q[("2024-01-01", h)].hour_quota for h in ("01", "02", "03")] == [3, 1, 0]
    got = sample_sessions(s, total=5)
    assert sorted((r.hour, r.draw_rank) for r in got.collect()) == [("01", 1), ("01", 2), ("01", 3), ("02", 1)]


def test_more_than_total_days_gives_empty_sample(spark):
    base = dt.datetime(2020, 1, 1)
    starts = [(base + dt.timedelta(days=i)).isoformat(sep=" ") for i in range(120)]
    s = _sessions(spark, starts)
    q = hour_quotas(hour_counts(s), total=100)
    assert {r.day_quota for r in q.collect()} == {0}
    assert sample_sessions(s, total=100).count() == 0


def _full(spark):
    from clickpath.plans.catalog import _full as full

    return full(spark, SF01)


def test_sample_properties(spark):
    s = _full(spark)
    total = 3000
    a = sample_sessions(s, total, "7")
    rows = a.select("session_id", "date", "hour", "draw_rank").collect()
    ids = [r.session_id for r in rows]
    assert 0 < len(ids) <= total and len(ids) == len(set(ids))
    per_hour = {}
    for r in rows:
        per_hour.setdefault((r.date, r.hour), []).append(r.draw_rank)
    sizes = _quota_map(hour_quotas(hour_counts(s), total))
    for key, ranks in per_hour.items():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
        assert len(ranks) == sizes[key].hour_quota <= sizes[key].sessions
    # same seed, same sample; another seed, another sample
    again = {r.session_id for r in sample_sessions(s, total, "7").select("session_id").collect()}
    other = {r.session_id for r in sample_sessions(s, total, "8").select("session_id").collect()}
    assert again == set(ids) and other != set(ids)


def test_salted_path_equals_single_window(spark):
    s = _full(spark)
    total = 3000
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "1000")  # total above the threshold: salted two-phase draw
        salted_df = sample_sessions(s, total, "3", salt_buckets=5).select("session_id", "draw_rank")
        salted = {tuple(r) for r in salted_df.collect()}
        assert "_salt" in salted_df._jdf.queryExecution().executedPlan().toString()
        spark.conf.set(key, "100000")
        plain_df = sample_sessions(s, total, "3", salt_buckets=1).select("session_id", "draw_rank")
        plain = {tuple(r) for r in plain_df.collect()}
    finally:
        spark.conf.set(key, old)
    assert salted == plain and len(plain) > 0


def test_small_total_uses_partial_group_limit(spark):
    s = _full(spark)
    df = sample_sessions(s, 100, "0")
    df.count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sample_details_all_actions_of_sampled_sessions(spark):
    acts = make_actions(
        spark,
        [action("a", 1, "2024-01-01 05:00:00"), action("a", 1, "2024-01-01 05:00:09"), action("b", 2, "2024-01-01 05:00:00")],
    )
    sample = spark.createDataFrame([("a",)], "session_id string")
    got = sample_details(sample, acts)
    assert got.count() == 2 and {r.session_id for r in got.collect()} == {"a"}
    assert got.where(F.col("session_id") == "b").count() == 0
