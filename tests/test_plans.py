"""Physical-plan hygiene of every registered query (planning only, nothing runs)."""

from __future__ import annotations

import pytest

from clickpath.plans.catalog import QUERIES, _Tables
from tests.conftest import SF01

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SortAggregate"]
NEEDS_SESSION_SETS = {"session_agg", "session_full", "kv_get", "kv_set", "time_minus", "sample_sessions"}


def _plan(spark, name):
    return QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_slow_operators(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, op
    if name.startswith("filter_"):
        return
    if name not in NEEDS_SESSION_SETS:
        # list columns are pruned when unused, the session aggregate is a plain hash aggregate
        assert "ObjectHashAggregate" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "aggr_stat_all")
    schemas = [line for line in plan.split("\n") if "ReadSchema" in line]
    events = [s for s in schemas if "event_id" in s or "ts:" in s]
    assert events and all("value" not in s and "props" not in s for s in events)


def test_top_k_sides_are_broadcast(spark):
    plan = _plan(spark, "top_session_details")
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert "Window [row_number()" in plan and "_salt" in plan  # two-phase rank


def _smj_children_are_plain_shuffles(plan: str) -> bool:
    """Every SortMergeJoin reads Sort(Exchange ...) on both sides (the shape AQE's skew split needs)."""
    lines = plan.split("\n")
    found = False
    for i, line in enumerate(lines):
        if "SortMergeJoin" not in line:
            continue
        found = True
        depth = len(line) - len(line.lstrip(" :+-"))
        kids = [j for j in range(i + 1, len(lines)) if len(lines[j]) - len(lines[j].lstrip(" :+-")) == depth + 3]
        kids = [j for j in kids if lines[j].strip(" :").startswith(("+-", ":-"))][:2]
        for j in kids:
            if "Sort " not in lines[j] or "Exchange hashpartitioning" not in lines[j + 1]:
                return False
    return found


def test_big_joins_keep_the_shape_for_skew_splitting(spark, tmp_path):
    from clickpath.operators import apply_filter, full_sessions, session_category_counts, weighted_items
    from clickpath.sources.adapter import load_actions, load_users

    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")  # large-table view
        actions, users = load_actions(spark, SF01), load_users(spark, SF01)
        sessions_df = full_sessions(actions, users, with_lists=False)
        assert _smj_children_are_plain_shuffles(sessions_df._jdf.queryExecution().executedPlan().toString())
        path = str(tmp_path / "s")
        sessions_df.write.parquet(path)
        sessions = spark.read.parquet(path)
        items = weighted_items(apply_filter(sessions), session_category_counts(actions))
        assert _smj_children_are_plain_shuffles(items._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set(key, old)


def test_items_are_computed_once(spark):
    """Both rankings of the active sessions read one written table: nothing else scans the log."""
    plan = _plan(spark, "top_sessions")
    assert "Scan ExistingRDD" in plan and "Scan parquet" not in plan and "events" not in plan
    plan = _plan(spark, "top_session_details")
    assert plan.count("FileScan parquet") == 1  # the rows of the ranked sessions


def test_one_kind_reads_one_kind(spark):
    """The rows of the other kinds are filtered out before anything is exploded or aggregated."""
    assert "Generate" not in _plan(spark, "click_counts")
    for name, kind in (("click_counts", "click"), ("order_counts", "signup"), ("pay_counts", "purchase")):
        assert any("Filter" in line and f"= {kind})" in line for line in _plan(spark, name).split("\n")), name


COUNTING = [
    "category_ids", "click_counts", "order_counts", "pay_counts", "category_counts", "category_counts_joined", "top_categories",
    "category_session_clicks", "top_sessions",
]


#: queries whose counts per (session, category) are computed once and written: their plan is checked before that
WRITTEN = {"category_counts_joined", "top_sessions"}


@pytest.mark.parametrize("threshold", ["-1", "500000", "10m"])
@pytest.mark.parametrize("name", COUNTING)
def test_counts_join_no_raw_actions(spark, name, threshold):
    """The log is aggregated per (session, category) before any join: below every
    join input that comes from an explode there is an aggregate."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, threshold)
        written = _Tables(spark, SF01).items._jdf.queryExecution().executedPlan().toString()
        lines = (written if name in WRITTEN else _plan(spark, name)).split("\n")
    finally:
        spark.conf.set(key, old)
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    explodes = [i for i, x in enumerate(lines) if "Generate explode" in x or "Generate posexplode" in x]
    assert explodes or name == "click_counts"  # clicks are a column
    for i in explodes:
        at, seen = depth[i], []
        for j in range(i, -1, -1):  # ancestors of the explode, nearest first
            if depth[j] < at:
                at = depth[j]
                seen.append(lines[j])
        joins = [k for k, x in enumerate(seen) if "Join" in x]
        assert not joins or any("HashAggregate" in x for x in seen[: joins[0]])
