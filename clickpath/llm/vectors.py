"""Embedding rows that take part in an operator, and their matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable_vectors(table: DataFrame, vector: str, *columns, limit: float = float("inf")) -> DataFrame:
    """``columns`` of the rows whose vector has finite entries only, each below ``limit`` in
    size, and the vector as array<double> ``vec``."""
    v = table.select(*columns, F.col(vector).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(limit)))
    return v.where(F.col("vec").isNotNull()).where(F.coalesce(fine, F.lit(False)))


def usual_length(rows: DataFrame) -> tuple[int, int]:
    """The commonest length of ``vec`` (the larger, if tied) and its number of rows."""
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return (size["d"], size["n"]) if size else (0, 0)


def matrix(column, width: int) -> np.ndarray:
    """Arrow list column → one row per list (of ``width`` entries each)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
