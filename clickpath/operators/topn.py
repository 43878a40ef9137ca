"""Top rows per group that stay distributed when one group is huge.

``row_number() over (partition by g order by o) <= n`` sends each group to one
task. ``ranked_top`` ranks in two phases: first inside (group, salt) buckets,
``salt = xxhash64(key) mod buckets``, behind an explicit exchange on all those
columns (a partitioning on the group alone would satisfy the window too and
keep the group together), keeping each bucket's first ``n`` (or the row's own
``limit``); then among the survivors of each group. Every row of the group's
top ``n`` is in its bucket's top ``n``, so the result is exact. There are as many
buckets as shuffle partitions, so the first phase spreads as wide as the
session allows, and the last task of a group reads at most ``buckets * n`` rows,
however many tasks wrote them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def salt_buckets_of(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def ranked_top(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    max_rank: int,
    rank_col: str = "rank",
    limit: Column | None = None,
    salt_key: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Rows whose ``row_number`` within ``by`` (ordered by ``order``) is at most
    ``max_rank`` and, when given, at most the per-row ``limit`` column (which
    must never exceed ``max_rank``). Adds ``rank_col``.
    """
    if salt_key is not None:
        bucket = Window.partitionBy(*by, "_salt").orderBy(*order)
        first = F.col("_r1") <= F.lit(max_rank)
        if limit is not None:
            first = first & (F.col("_r1") <= limit)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(salt_key), F.lit(salt_buckets or salt_buckets_of(df))))
            .repartition(*by, "_salt")  # AQE may still coalesce small partitions
            .withColumn("_r1", F.row_number().over(bucket))
            .where(first)
            .drop("_salt", "_r1")
        )
    keep = F.col(rank_col) <= F.lit(max_rank)
    if limit is not None:
        keep = keep & (F.col(rank_col) <= limit)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(keep)
