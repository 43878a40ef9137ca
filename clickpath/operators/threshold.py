"""The draw of the sessions with the smallest hashes per hour, by radix thresholds.

A ranking of all sessions of an hour sorts them all to keep a few. Here one counting
pass gives, for every hour, how many sessions fall into each bin of the hash; the running
sum over the bins in hash order finds the bin in which the hour's quota is reached. Only
sessions in bins that begin before the quota is full are ranked, each bin by itself:
the rank of a session is the number of sessions in lower bins plus its rank in its own.

Bins are the exponent and the leading bits of the hash, ``BINS_PER_OCTAVE`` for every
factor of two, so a bin holds about a twentieth of what lies below it: what is ranked
beyond the quota follows the quota, not the hour. A hot hour is counted by all tasks, and
its ranking is spread over its bins. The draw is exact and equals that of
``sampling.sample_sessions``.

The bins that are drawn from are at most as many as the sessions to draw (each is
preceded by a different number of sessions below the quota), so their table is broadcast
up to ``BROADCAST_ROWS`` of these and joined by a shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL, quota_columns, with_hour_key
from clickpath.operators.sessions import BROADCAST_ROWS
from clickpath.session import cut_lineage

BINS_PER_OCTAVE = 16


def draw_hash(seed: str = DEFAULT_SEED) -> Column:
    """The text that sessions are drawn by, smallest first."""
    return F.md5(F.concat(F.col("session_id"), F.lit(":"), F.lit(str(seed))))


def hash_bin(draw: Column) -> Column:
    """Bin of a draw hash; it never falls when the hash rises."""
    leading = F.conv(F.substring(draw, 1, 15), 16, 10).cast("long")
    return F.floor(F.log2(leading + 1) * BINS_PER_OCTAVE).cast("int")


def bin_counts(sessions: DataFrame, seed: str = DEFAULT_SEED) -> DataFrame:
    """``(date, hour, bin, n)``: a fixed number of rows per hour at most."""
    keyed = with_hour_key(sessions.select("session_id", "start_time")).withColumn("bin", hash_bin(draw_hash(seed)))
    return keyed.groupBy("date", "hour", "bin").agg(F.count(F.lit(1)).alias("n"))


def drawn_bins(counts: DataFrame, total: int = DEFAULT_TOTAL) -> DataFrame:
    """``(date, hour, bin, below, hour_quota)`` of the bins that begin before their hour's quota is full."""
    hour = Window.partitionBy("date", "hour")
    lower = hour.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    days = counts.select(F.count_distinct("date")).scalar().cast("long")
    out = (
        counts.withColumn("sessions", F.sum("n").over(hour))
        .withColumn("day_sessions", F.sum("n").over(Window.partitionBy("date")))
        .withColumn("below", F.coalesce(F.sum("n").over(lower), F.lit(0).cast("long")))
    )
    return quota_columns(out, total, days).where("below < hour_quota").select("date", "hour", "bin", "below", "hour_quota")


def threshold_sample(sessions: DataFrame, total: int = DEFAULT_TOTAL, seed: str = DEFAULT_SEED) -> DataFrame:
    """The sampled session rows (all input columns plus date, hour, draw rank). ``sessions`` is
    read twice: pass a written table."""
    bins = drawn_bins(cut_lineage(bin_counts(sessions, seed)), total)
    if total <= BROADCAST_ROWS:
        bins = F.broadcast(bins)
    keyed = with_hour_key(sessions).withColumn("_draw", draw_hash(seed)).withColumn("bin", hash_bin(F.col("_draw")))
    own = Window.partitionBy("date", "hour", "bin").orderBy("_draw", "session_id")
    ranked = keyed.join(bins, ["date", "hour", "bin"]).withColumn("draw_rank", (F.col("below") + F.row_number().over(own)).cast("int"))
    return ranked.where("draw_rank <= hour_quota").select(*sessions.columns, "date", "hour", "draw_rank")
