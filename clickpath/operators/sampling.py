"""Random session sample spread over days and hours in proportion to traffic.

``total`` sessions are split evenly over the days present (integer division),
each day's share over its hours in proportion to the hour's sessions
(rounded down, at most the hour's sessions). Inside an hour the sessions
are ranked by ``md5(session_id || ':' || seed)`` and the first ``quota``
kept: a uniform draw without replacement that is the same on every run and
under any partitioning.

Plan shape: the per-hour counts are a small table (at most 24 rows per
calendar day, a bound set by the date span, not by the data volume); the
quota arithmetic runs on it (day totals by a date-partitioned window, the
number of days by a scalar subquery) and it is broadcast into the join with
the sessions.

The draw is a ``row_number`` per (date, hour) bounded by ``total`` (every hour
quota is at most the day quota, at most ``total``), run by
``topn.ranked_top``: a salted two-phase rank, so the sessions of a hot hour
(say a third of all) are ranked by many tasks, and the last one reads at most
the hour's quota from each of them. Pass sessions without their set columns
(``aggregate_sessions(..., with_lists=False)``): the draw then moves
fixed-width rows, and the sets are attached to the drawn sessions only.

Detail rows of the sample join a side of at most ``total`` rows, a proven
bound, so it is broadcast and the action log is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.functions.dates import format_date, hour_text
from clickpath.operators.sessions import BROADCAST_ROWS
from clickpath.operators.topn import ranked_top

DEFAULT_TOTAL = 100
DEFAULT_SEED = "0"


def with_hour_key(sessions: DataFrame) -> DataFrame:
    """Adds ``date`` (yyyy-MM-dd) and ``hour`` (HH) of the session start."""
    return sessions.withColumn("date", format_date("start_time")).withColumn("hour", hour_text("start_time"))


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start."""
    return (
        with_hour_key(sessions.select("start_time"))
        .groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


def hour_quotas(counts: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """Per (date, hour): sessions, day sessions, days, day quota and hour quota.

    ``counts`` is the output of :func:`hour_counts`. The number of days is a
    scalar subquery (a distributed distinct count whose single value is
    inlined into the plan), the day totals a window partitioned by date: no
    step gathers the table into one partition.
    """
    days = counts.select(F.count_distinct("date")).scalar().cast("long")
    out = quota_columns(counts.withColumn("day_sessions", F.sum("sessions").over(Window.partitionBy("date"))), total, days)
    return out.select("date", "hour", "sessions", "day_sessions", "days", "day_quota", "hour_quota")


def quota_columns(counts: DataFrame, total: int, days: Column) -> DataFrame:
    """Adds ``days``, ``day_quota`` and ``hour_quota`` to rows with ``sessions`` and ``day_sessions``."""
    # `div` is Spark's exact integral division
    return (
        counts.withColumn("days", days)
        .withColumn("day_quota", F.expr(f"CAST({int(total)} AS BIGINT) div days"))
        .withColumn("hour_quota", F.expr("least(sessions, (sessions * day_quota) div day_sessions)"))
    )


def sample_sessions(
    sessions: DataFrame,
    total: int = DEFAULT_TOTAL,
    seed: str = DEFAULT_SEED,
    salt_buckets: int | None = None,
) -> DataFrame:
    """The sampled session rows (all input columns plus date, hour, draw rank)."""
    keyed = with_hour_key(sessions)
    quotas = hour_quotas(hour_counts(sessions), total).where(F.col("hour_quota") > 0)
    # the quota table has at most 24 rows per calendar day: broadcast, so the
    # sessions are not shuffled by (date, hour) for the join
    small = F.broadcast(quotas.select("date", "hour", "hour_quota"))
    cand = keyed.join(small, ["date", "hour"], "inner").withColumn(
        "_draw", F.md5(F.concat(F.col("session_id"), F.lit(":"), F.lit(str(seed))))
    )
    ranked = ranked_top(
        cand,
        by=["date", "hour"],
        order=[F.col("_draw"), F.col("session_id")],
        max_rank=total,  # hour quota <= day quota <= total
        rank_col="draw_rank",
        limit=F.col("hour_quota"),
        salt_key="session_id",
        salt_buckets=salt_buckets,
    )
    return ranked.drop("hour_quota", "_draw")


def sample_details(sample: DataFrame, actions: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """All actions of the sampled sessions (the sample has at most ``total`` rows)."""
    ids = sample.select("session_id")
    if total <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return actions.join(ids, "session_id", "inner")
