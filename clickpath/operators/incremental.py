"""Session statistics kept up to date period by period.

The log comes in periods (days, say). An update reads the actions of one period and the
sessions that were still open at its start, and writes two small tables under the state
folder: the counters of the sessions that ended, and the sessions that are open at its
end. Counters of periods merge exactly (``stats.merge_counters``), so totals need no pass
over the log.

A session is open at the edge of a period if its last action lies at most ``idle`` before
it; otherwise it has ended, and a later action with the same id begins a new part of it. A
full run over the log with the same rule gives the same counters; with sessions that
never pause longer than ``idle`` across an edge, these are the counters of the whole sessions.

Each period is a folder of its own that an update overwrites, so repeating one changes
nothing, and a corrected period replaces itself. What a correction leaves open may differ:
:func:`update_from` runs the periods after it again, until the open sessions come out
as they were. An update reads nothing but its own period, so its cost does not grow
with the log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions.dates import ntz_literal, seconds_between
from clickpath.operators.sessions import aggregate_sessions, attach_users, first_user
from clickpath.operators.stats import merge_counters, session_counters
from clickpath.session import folder_exists
from clickpath.sources.sinks import write_parquet

OPEN_SCHEMA = "session_id string, user_id long, start_time timestamp_ntz, end_time timestamp_ntz, step_length long"
IDLE = dt.timedelta(minutes=30)


def _text(at: dt.datetime) -> str:
    return at.isoformat(sep=" ", timespec="seconds")


def period_folder(state: str, kind: str, start: dt.datetime) -> str:
    return f"{state.rstrip('/')}/{kind}/period={start:%Y%m%dT%H%M%S}"


def in_period(start: dt.datetime, end: dt.datetime) -> Column:
    at = F.col("action_time")
    return (at >= ntz_literal(_text(start))) & (at < ntz_literal(_text(end)))


def merged_sessions(parts: DataFrame) -> DataFrame:
    """One row per session of partial sessions (``OPEN_SCHEMA``), with its visit length."""
    out = parts.groupBy("session_id").agg(
        first_user(F.col("start_time"), F.col("user_id")).alias("user_id"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("step_length").alias("step_length"),
    )
    return out.withColumn("visit_length", seconds_between("start_time", "end_time"))


def update_period(
    spark: SparkSession,
    state: str,
    actions: DataFrame,
    users: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    previous: dt.datetime | None = None,
    idle: dt.timedelta = IDLE,
) -> None:
    """Write the counters and the open sessions of ``[start, end)``. ``previous`` is the start of the
    period before, whose open sessions are carried on (none for the first)."""
    columns = ["session_id", "user_id", "start_time", "end_time", "step_length"]
    own = aggregate_sessions(actions.where(in_period(start, end)), with_lists=False).select(*columns)
    if previous is not None:
        own = own.unionByName(spark.read.schema(OPEN_SCHEMA).parquet(period_folder(state, "open", previous)))
    sessions = merged_sessions(own)
    is_open = F.col("end_time") >= ntz_literal(_text(end - idle))
    # both are needed, and the sessions of a period are small beside its log: written once
    folder = period_folder(state, "sessions", start)
    write_parquet(sessions, folder)
    sessions = spark.read.schema(sessions.schema).parquet(folder)
    write_parquet(session_counters(attach_users(sessions.where(~is_open), users)), period_folder(state, "counters", start))
    write_parquet(sessions.where(is_open).select(*columns), period_folder(state, "open", start))


def _open_digest(spark: SparkSession, state: str, start: dt.datetime) -> tuple | None:
    folder = period_folder(state, "open", start)
    if not folder_exists(spark, folder):
        return None
    rows = spark.read.schema(OPEN_SCHEMA).parquet(folder)
    return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first())


def update_from(
    spark: SparkSession,
    state: str,
    actions: DataFrame,
    users: DataFrame,
    edges: Sequence[dt.datetime],
    first: int = 0,
    idle: dt.timedelta = IDLE,
) -> list[int]:
    """Update the periods between consecutive ``edges`` from number ``first`` on, and stop after the
    first one that leaves the same sessions open as before. Returns the numbers that ran."""
    ran = []
    for k in range(first, len(edges) - 1):
        before = _open_digest(spark, state, edges[k])
        update_period(spark, state, actions, users, edges[k], edges[k + 1], edges[k - 1] if k else None, idle)
        ran.append(k)
        if before is not None and before == _open_digest(spark, state, edges[k]):
            break
    return ran


def total_counters(spark: SparkSession, state: str, users: DataFrame, starts: Sequence[dt.datetime]) -> DataFrame:
    """Counters of all periods and of the sessions that are open at the end of the last one."""
    ended = [spark.read.parquet(period_folder(state, "counters", s)) for s in starts]
    rest = spark.read.schema(OPEN_SCHEMA).parquet(period_folder(state, "open", starts[-1]))
    rest = rest.withColumn("visit_length", seconds_between("start_time", "end_time"))
    return merge_counters(*ended, session_counters(attach_users(rest, users)))
