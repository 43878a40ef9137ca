"""Distribution of session visit length and step length.

One global aggregate of conditional counts: every task reduces its sessions
to one row of 16 counters, the final step merges one row per task. The
counts are exact and computed once per action (no accumulator updated from
inside a lazy filter, so retries cannot double count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.functions.numbers import ratio
from clickpath.schemas import (
    STEP_LENGTH_BUCKETS,
    VISIT_LENGTH_BUCKETS,
    step_ratio_column,
    visit_ratio_column,
)


def _in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    return c >= F.lit(lo) if hi is None else c.between(F.lit(lo), F.lit(hi))


def bucket_of(c: Column | str, buckets: list[tuple[str, int, int | None]]) -> Column:
    """Name of the bucket holding ``c``; null when none does (e.g. length 0)."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for name, lo, hi in buckets:
        cond = _in_bucket(c, lo, hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def visit_bucket(c: Column | str = "visit_length") -> Column:
    return bucket_of(c, VISIT_LENGTH_BUCKETS)


def step_bucket(c: Column | str = "step_length") -> Column:
    return bucket_of(c, STEP_LENGTH_BUCKETS)


def _counts(sessions: DataFrame, visit: Column, step: Column) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.count_if(_in_bucket(visit, lo, hi)).alias(f"v_{n}") for n, lo, hi in VISIT_LENGTH_BUCKETS]
    aggs += [F.count_if(_in_bucket(step, lo, hi)).alias(f"s_{n}") for n, lo, hi in STEP_LENGTH_BUCKETS]
    return sessions.agg(*aggs)


COUNTER_COLUMNS = (
    ["session_count"] + [f"v_{n}" for n, _, _ in VISIT_LENGTH_BUCKETS] + [f"s_{n}" for n, _, _ in STEP_LENGTH_BUCKETS]
)


def session_counters(
    sessions: DataFrame, visit: Column | str = "visit_length", step: Column | str = "step_length"
) -> DataFrame:
    """One row of the 16 counters: sessions, 9 visit-length and 6 step-length buckets.

    Counters of separate runs (days, batches) merge exactly with
    :func:`merge_counters`; :func:`stat_from_counters` turns them into shares.
    """
    visit = F.col(visit) if isinstance(visit, str) else visit
    step = F.col(step) if isinstance(step, str) else step
    return _counts(sessions, visit, step)


def merge_counters(*counters: DataFrame) -> DataFrame:
    """Element-wise sum of counter rows (any number of rows per input)."""
    rows = counters[0]
    for other in counters[1:]:
        rows = rows.unionByName(other)
    zero = F.lit(0).cast("long")
    return rows.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in COUNTER_COLUMNS])


def stat_from_counters(counters: DataFrame) -> DataFrame:
    """Shares (2 decimals, half-up) from one counter row; null when there is no session."""
    cols = [F.col("session_count")]
    cols += [ratio(f"v_{n}", "session_count").alias(visit_ratio_column(n)) for n, _, _ in VISIT_LENGTH_BUCKETS]
    cols += [ratio(f"s_{n}", "session_count").alias(step_ratio_column(n)) for n, _, _ in STEP_LENGTH_BUCKETS]
    return counters.select(*cols)


def aggr_stat(
    sessions: DataFrame, visit: Column | str = "visit_length", step: Column | str = "step_length"
) -> DataFrame:
    """One row: ``session_count`` and the 15 bucket shares (2 decimals, half-up).

    Shares are null when there is no session.
    """
    return stat_from_counters(session_counters(sessions, visit, step))


def length_histogram(
    sessions: DataFrame, kind: str = "visit", value: Column | str | None = None
) -> DataFrame:
    """Long form ``(bucket, sessions, ratio)``, one row per bucket, empty buckets included."""
    if kind == "visit":
        buckets, default = VISIT_LENGTH_BUCKETS, "visit_length"
    elif kind == "step":
        buckets, default = STEP_LENGTH_BUCKETS, "step_length"
    else:
        raise ValueError("kind must be 'visit' or 'step'")
    v = value if value is not None else default
    v = F.col(v) if isinstance(v, str) else v
    counts = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.count_if(_in_bucket(v, lo, hi)).alias(f"b{i}") for i, (_, lo, hi) in enumerate(buckets)],
    )
    rows = F.array(
        *[F.struct(F.lit(name).alias("bucket"), F.col(f"b{i}").alias("sessions")) for i, (name, _, _) in enumerate(buckets)]
    )
    return counts.select("session_count", F.explode(rows).alias("r")).select(
        F.col("r.bucket").alias("bucket"),
        F.col("r.sessions").alias("sessions"),
        ratio("r.sessions", "session_count").alias("ratio"),
    )
