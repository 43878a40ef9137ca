"""Results do not depend on the shuffle partition count or the session time zone."""

from __future__ import annotations

import pytest

from clickpath.plans.catalog import QUERIES
from tests.conftest import SF01

NAMES = ["session_full", "sample_sessions", "top_sessions", "top_categories", "aggr_stat_all", "hour_counts"]


def _collect(spark, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF01).collect())


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_invariance(spark, name):
    base = _collect(spark, name)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        three = _collect(spark, name)
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        seventeen = _collect(spark, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == three == seventeen


@pytest.mark.parametrize("name", ["session_full", "sample_sessions", "date_keys", "pad_two", "action_range", "actions"])
def test_time_zone_invariance(spark, name):
    base = _collect(spark, name)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = _collect(spark, name)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        third = _collect(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other == third
