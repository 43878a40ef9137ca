"""Connected components of an edge table by alternating star operations.

Large star: every node hands its larger neighbours to its smallest one;
small star: its smaller neighbours. The steps are repeated until no edge
changes, which takes a logarithmic number of rounds on long chains. Each
round is checkpointed in the shared folder; the minima are dealt evenly before they
are joined back, so both join sides are plain shuffles and a node with very
many neighbours can be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import materialize, release_files


#: edges that one partition holds; the number of partitions follows the number of edges left
PARTITION_EDGES = 250_000


def _hand_over(edges: DataFrame, larger: bool, parts: int) -> DataFrame:
    spark = edges.sparkSession
    if larger:
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    if parts > 1:  # a single partition is joined in place
        least = materialize(spark, least.repartition(parts))
    joined = both.join(least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (a long, b long) that has a
    neighbour; the component is its smallest node. Loops and repeated edges
    are allowed, null ends are dropped."""
    spark = edges.sparkSession
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = materialize(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (state := _state(edges)) != before:
        before = state
        parts = max(1, -(-state[0] // PARTITION_EDGES))
        edges = edges.coalesce(parts)
        edges = materialize(spark, _hand_over(_hand_over(edges, True, parts), False, parts))
        if parts > 1:  # else there is little to remove
            release_files(spark)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
