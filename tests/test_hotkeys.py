"""Salted user join: equal to the plain one, whatever the users' shares."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickpath.operators import attach_users, dedupe_users
from clickpath.operators.hotkeys import attach_users_salted, hot_users
from tests.conftest import make_users, user

COLUMNS = "session_id string, user_id long, step_length long"


@pytest.fixture(scope="module")
def sessions(spark):
    own = lambda k: 1 if k % 3 == 0 else 2 if k % 10 == 1 else None if k % 50 == 2 else 100 + k
    return spark.createDataFrame([(f"s{k}", own(k), k) for k in range(3000)], COLUMNS).cache()


def users_of(spark):
    return make_users(spark, [user(1, 30), user(1, 20, city=7), user(2, 40), user(3, 50)] + [user(100 + k) for k in range(0, 3000, 2)])


def test_equals_the_plain_join(spark, sessions):
    users = users_of(spark)
    for share in (0.001, 0.05, 0.9):
        got = sorted(map(tuple, attach_users_salted(sessions, users, share).collect()))
        assert got == sorted(map(tuple, attach_users(sessions, dedupe_users(users)).collect()))
    assert len(got) == len({r[0] for r in got}) > 1300 and {r[3] for r in got if r[1] == 1} == {20}


def test_hot_users_are_found(spark, sessions):
    assert sessions.where("user_id = 2").count() > 150
    assert hot_users(sessions, 0.05) == {1: 7, 2: 2} and hot_users(sessions, 0.2) == {1: 2}
    assert hot_users(sessions.where("user_id is null"), 0.05) == {} == hot_users(sessions.where("step_length < 0"), 0.05)


def test_no_key_holds_a_large_part(spark, sessions):
    """A third of all sessions are one user's; no (user, salt) pair has more than a few percent."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        plan = attach_users_salted(sessions, users_of(spark), 0.01)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning(user_id") >= 2 and "_salt" in plan
    parts = sessions.where("user_id = 1").groupBy(F.pmod(F.xxhash64("session_id"), F.lit(hot_users(sessions, 0.01)[1]))).count()
    assert parts.count() == 34 and parts.agg(F.max("count")).first()[0] < 0.02 * sessions.count()


def test_empty_tables(spark, sessions):
    assert attach_users_salted(sessions.where("step_length < 0"), users_of(spark)).collect() == []
    assert attach_users_salted(sessions, users_of(spark).where("user_id < 0")).collect() == []
