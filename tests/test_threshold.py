"""The draw by radix thresholds: equal to the ranking of all sessions, and what it reads."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from clickpath.operators import aggregate_sessions, attach_users
from clickpath.operators.sampling import sample_sessions
from clickpath.operators.threshold import bin_counts, draw_hash, drawn_bins, hash_bin, threshold_sample
from clickpath.plans.catalog import QUERIES
from clickpath.sources.adapter import load_actions, load_users
from tests.conftest import SF01, action, make_actions


@pytest.fixture(scope="module")
def sessions(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sessions") / "s")
    attach_users(aggregate_sessions(load_actions(spark, SF01), False), load_users(spark, SF01)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("total", [1, 40, 500, 3000, 10**9])
def test_equals_the_ranking_of_all_sessions(spark, sessions, total):
    columns = ["session_id", "date", "hour", "draw_rank", "user_id", "step_length"]
    got = sorted(tuple(r) for r in threshold_sample(sessions, total, "5").select(*columns).collect())
    assert got == sorted(tuple(r) for r in sample_sessions(sessions, total, "5").select(*columns).collect())
    assert (len(got) > 0) == (total >= 500)


def test_bins_rise_with_the_hash(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("session_id"))
    rows = ids.select(draw_hash("x").alias("h"), hash_bin(draw_hash("x")).alias("b")).orderBy("h").collect()
    assert rows[0].h == min(hashlib.md5(f"{i}:x".encode()).hexdigest() for i in range(20000))
    bins = [r.b for r in rows]
    assert bins == sorted(bins) and 100 < len(set(bins)) < 400
    edges = spark.createDataFrame([("0" * 32,), ("0" * 14 + "1" + "0" * 17,), ("f" * 32,)], "h string").select(hash_bin(F.col("h"))).collect()
    assert [r[0] for r in edges] == [0, 16, 960]


def hot_hour(spark, n=4000):
    rows = [action(f"s{i}", i % 50, "2024-01-01 10:00:00") for i in range(n)] + [action("t", 1, "2024-01-01 11:00:00"), action("u", 1, "2024-01-02 11:00:00")]
    return aggregate_sessions(make_actions(spark, rows), False)


def test_only_sessions_around_the_threshold_are_ranked(spark):
    sessions, total = hot_hour(spark), 200
    bins = drawn_bins(bin_counts(sessions), total)
    assert bins.count() <= total
    ranked = bin_counts(sessions).join(bins.select("date", "hour", "bin"), ["date", "hour", "bin"]).agg(F.sum("n")).first()[0]
    drawn = threshold_sample(sessions, total).count()
    assert drawn == 100 and drawn <= ranked <= 1.2 * drawn + 2


def test_sessions_without_time_and_empty_tables(spark):
    sessions = aggregate_sessions(make_actions(spark, [action("a", 1, "2024-01-01 10:00:00"), action("b", 1, None)]), False)
    assert [r.session_id for r in threshold_sample(sessions, 10).collect()] == ["a"]
    assert threshold_sample(sessions.where("session_id = 'x'"), 10).collect() == []


def test_registered_sample_ranks_per_bin(spark):
    plan = QUERIES["sample_sessions"](spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "row_number()" in line and "Window [" in line]
    assert windows and all("bin#" in line for line in windows)
