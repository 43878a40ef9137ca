"""Layouts of the log: run-time pruning by day, joins by session without an exchange."""

from __future__ import annotations

import pytest

from clickpath.operators import aggregate_sessions, attach_users, weighted_details
from clickpath.sources.adapter import load_actions, load_users
from clickpath.sources.layout import actions_on_days, bucketed_details, write_bucketed, write_by_day
from tests.conftest import SF01


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return load_actions(spark, SF01), load_users(spark, SF01)


def test_days_of_a_table_prune_the_scan(spark, tables, tmp_path):
    actions, _ = tables
    log = write_by_day(actions, str(tmp_path / "log"))
    assert sorted(map(str, log.collect())) == sorted(map(str, actions.collect()))
    path = str(tmp_path / "days")
    actions.groupBy("date").count().write.parquet(path)
    days = spark.read.parquet(path).where("date >= '2024-01-05' AND date < '2024-01-08'")
    got = actions_on_days(log, days)
    plan = plan_of(got)
    assert "dynamicpruning" in plan.replace(" ", "").lower() and "PartitionFilters: [" in plan
    wanted = actions.where("date >= '2024-01-05' AND date < '2024-01-08'")
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) and wanted.count() > 0
    scan = got._jdf.queryExecution().executedPlan()
    read = [line for line in scan.toString().split("\n") if "FileScan parquet" in line and "session_id" in line]
    assert read and all("dynamicpruning" in line.lower() for line in read)


def test_bucketed_tables_join_as_they_lie(spark, tables):
    actions, users = tables
    sessions = attach_users(aggregate_sessions(actions, False), users)
    more = sessions.unionByName(sessions.where("step_length > 3"))  # sessions listed twice
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        log = write_bucketed(actions, "layout_test_actions", 6)
        listed = write_bucketed(more, "layout_test_sessions", 6)
        got = bucketed_details(listed, log)
        plan = plan_of(got)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = weighted_details(more, actions).select(*actions.columns, "copies")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set(key, old)
        for name in ("layout_test_actions", "layout_test_sessions"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
