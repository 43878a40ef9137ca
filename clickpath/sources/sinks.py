"""Sinks for the analysis outputs.

The analysed job printed its records from executors or the driver; here
every output is a DataFrame written by the executors in parallel. Writes
go through Spark's commit protocol, so a lost executor only re-runs its
tasks and a half-written folder is never published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df`` as parquet; ``partition_by`` gives folder pruning on read."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Write ``df`` to a relational database table (rows go out per partition)."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
