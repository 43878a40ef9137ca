"""Layouts of the action log that later jobs prune and join without a shuffle.

* By day: one folder per ``date``. A set of days that is known only at run time (a table)
  reaches the scan as a dynamic partition filter, so folders of other days are not read.
* By session: a bucketed and sorted table. Tables with the same buckets join on
  ``session_id`` as they lie; the log is not exchanged again by any later join.

A session with a third of all rows is one bucket: the layout suits logs without such
sessions (``sessions.weighted_details`` splits them at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.sources.sinks import write_parquet


def write_by_day(actions: DataFrame, path: str) -> DataFrame:
    """The log in one folder per day, reread. Rows are dealt by day and hash, so a busy day is written by several tasks."""
    spark = actions.sparkSession
    dealt = actions.repartition("date", F.pmod(F.xxhash64("session_id"), F.lit(8)))
    write_parquet(dealt, path, partition_by=["date"])
    schema = actions.select(*[c for c in actions.columns if c != "date"], "date").schema
    return spark.read.schema(schema).parquet(path).select(*actions.columns)


def actions_on_days(log: DataFrame, days: DataFrame) -> DataFrame:
    """Actions of the days in a table with ``date``; one row per calendar day at most, so it is broadcast
    and its values prune the log's folders before they are read."""
    return log.join(F.broadcast(days.select("date").distinct()), "date", "left_semi").select(*log.columns)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "session_id") -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``, reread. Rows are dealt by the key first, so every
    bucket is one file."""
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_details(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """``sessions.weighted_details`` of two tables of :func:`write_bucketed` with the same buckets: the copies
    of a session are counted and joined where its bucket lies."""
    copies = sessions.groupBy("session_id").agg(F.count(F.lit(1)).alias("copies"))
    return actions.join(copies, "session_id").select(*actions.columns, "copies")
