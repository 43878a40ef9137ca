"""Statistics kept by period: equal to a full run, and repeatable."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from clickpath.operators.incremental import OPEN_SCHEMA, period_folder, total_counters, update_from, update_period
from clickpath.operators.stats import COUNTER_COLUMNS
from clickpath.schemas import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS
from tests.conftest import action, make_actions, make_users, user

IDLE = dt.timedelta(minutes=30)
EDGES = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(5)]
USERS = [user(1), user(2), user(3), user(3, age=50)]


def log(seed=4, n=260):
    rng = random.Random(seed)
    rows = []
    for k in range(n):  # many actions around midnight
        day, near = rng.randrange(4), rng.random() < 0.7
        second = rng.choice([rng.randrange(0, 2400), rng.randrange(84600, 86400)]) if near else rng.randrange(86400)
        at = EDGES[day] + dt.timedelta(seconds=second)
        rows.append((f"s{rng.randrange(60)}", rng.randint(1, 4), at.isoformat(sep=" ")))
    return rows


def brute(rows):
    parts, counters = [], dict.fromkeys(COUNTER_COLUMNS, 0)
    by_session: dict = {}
    for sid, uid, at in rows:
        by_session.setdefault(sid, []).append((dt.datetime.fromisoformat(at), uid))
    for own in by_session.values():
        own.sort()
        for at, uid in own:
            start = dt.datetime.combine(at.date(), dt.time())
            if parts and parts[-1][0] is own and parts[-1][1][-1][0] >= start - IDLE:
                parts[-1][1].append((at, uid))
            else:
                parts.append((own, [(at, uid)]))
    for _, own in parts:
        visit, step = int((own[-1][0] - own[0][0]).total_seconds()), len(own)
        for _ in [u for u in USERS if u[0] == own[0][1]]:  # a listed user id counts as often as it is listed
            counters["session_count"] += 1
            for prefix, value, buckets in (("v", visit, VISIT_LENGTH_BUCKETS), ("s", step, STEP_LENGTH_BUCKETS)):
                for name, lo, hi in buckets:
                    counters[f"{prefix}_{name}"] += lo <= value and (hi is None or value <= hi)
    return counters


def totals(spark, state, users, periods=4):
    return total_counters(spark, state, users, EDGES[:periods]).first().asDict()


@pytest.fixture(scope="module")
def tables(spark):
    rows = log()
    return rows, make_actions(spark, [action(*r) for r in rows]).cache(), make_users(spark, USERS)


def test_totals_equal_a_full_run_and_repeats_change_nothing(spark, tables, tmp_path):
    rows, actions, users = tables
    state = str(tmp_path)
    assert update_from(spark, state, actions, users, EDGES, idle=IDLE) == [0, 1, 2, 3]
    want = brute(rows)
    assert totals(spark, state, users) == want and want["session_count"] > 20
    carried = [spark.read.schema(OPEN_SCHEMA).parquet(period_folder(state, "open", e)).count() for e in EDGES[:4]]
    assert all(carried[:3])
    assert update_from(spark, state, actions, users, EDGES, first=1, idle=IDLE) == [1]  # the same sessions stay open
    assert totals(spark, state, users) == want


def test_a_corrected_day_replaces_itself(spark, tables, tmp_path):
    rows, actions, users = tables
    state = str(tmp_path)
    update_from(spark, state, actions, users, EDGES, idle=IDLE)
    more = [("s99", 2, "2024-01-02 23:50:00"), ("s99", 2, "2024-01-03 00:05:00"), ("s3", 1, "2024-01-02 12:00:00")]
    # the late rows of the second day reach into the third: both run, the fourth is as it was
    changed = make_actions(spark, [action(*r) for r in rows + more])
    assert update_from(spark, state, changed, users, EDGES, first=1, idle=IDLE)[:2] == [1, 2]
    assert totals(spark, state, users) == brute(rows + more)


def test_a_day_reads_only_itself_and_what_is_open(spark, tables, tmp_path):
    rows, actions, users = tables
    state = str(tmp_path)
    update_period(spark, state, actions, users, EDGES[0], EDGES[1], None, IDLE)
    only = actions.where(f"action_time >= timestamp_ntz'{EDGES[1]}' AND action_time < timestamp_ntz'{EDGES[2]}'")
    update_period(spark, state, only, users, EDGES[1], EDGES[2], EDGES[0], IDLE)
    assert totals(spark, state, users, 2) == brute([r for r in rows if r[2] < "2024-01-03"])
    assert sorted(os.listdir(f"{state}/counters")) == ["period=20240101T000000", "period=20240102T000000"]


def test_empty_periods(spark, tables, tmp_path):
    _, actions, users = tables
    update_from(spark, str(tmp_path), actions.where("session_id = 'none'"), users, EDGES, idle=IDLE)
    assert totals(spark, str(tmp_path), users) == dict.fromkeys(COUNTER_COLUMNS, 0)
