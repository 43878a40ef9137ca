"""Embedding whitening from a polarisation covariance.

Every entry ``c`` becomes the integer ``x = floor(1024 * c) + 100000``. One pass sums
every dimension. A second pass centres the integers and sums their exact squares for
every dimension and for the sum of every pair of dimensions. With
``Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b)`` the differences of these variances are all
covariances, so no product of two dimensions is ever formed. The matrix goes to
``eigh``; a row's projections on the leading components over their deviations are its
whitened coordinates. A third pass measures how far their covariance is from the
identity.

Exactness: rows are centred on the integer next below each mean, and what is left of
the mean is corrected in the sums, so squares stay small; they are added as 64-bit
integers where a bound proves that they fit, else as Python integers. Tasks send their
sums in 32-bit limbs, which Spark adds exactly. To the driver comes one number per
dimension and pair, whatever the rows.

Defined results: vectors that are null or hold null or non-finite entries take no
part, nor do vectors whose length is not the commonest one (the larger, if tied) or
with an entry of 2**51 or more in size, whose ``x`` would leave a long. Rows without
id and rows that repeat an id or a vector are rows like others, in the fit and in the
result. A component without variance (all vectors equal in it, or one row only) has no
whitened value, and the identity error leaves it out; equal eigenvalues have
any orthonormal basis of their space. Empty vectors and empty tables give no rows;
extra columns are ignored. There is no text; a vector of any length is one row of a
matrix block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.vectors import matrix, usable_vectors, usual_length

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = float(1 << 51)
#: rows of a matrix block
BLOCK = 4096
_LIMB = 32


def integers(values: np.ndarray) -> np.ndarray:
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


# ---------------------------------------------------------------- exact sums

def _limb_rows(totals: list[int]) -> pa.RecordBatch:
    """(slot, limb, value) of exact totals: lower limbs are not negative, the last is signed."""
    slot, limb, value = [], [], []
    for i, v in enumerate(totals):
        k = 0
        while True:
            last = -(1 << 62) <= v < 1 << 62 and (v >> _LIMB) in (0, -1)
            part = v if last else v & ((1 << _LIMB) - 1)
            if part:
                slot.append(i)
                limb.append(k)
                value.append(part)
            if last:
                break
            v >>= _LIMB
            k += 1
    return pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())], ["slot", "limb", "value"])


def exact_sums(rows: DataFrame, slots: int, width: int, part) -> list[int]:
    """Sums over all rows of the ``slots`` integers that ``part`` makes of every block of the
    integer matrix; one number per slot reaches the driver."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(slots, object)
        for batch in batches:
            x = integers(matrix(batch.column("vec"), width))
            for at in range(0, len(x), BLOCK):
                totals = totals + part(x[at : at + BLOCK]).astype(object)
        yield _limb_rows([int(t) for t in totals])

    sums = [0] * slots
    for r in rows.select("vec").mapInArrow(run, "slot int, limb int, value long").groupBy("slot", "limb").agg(F.sum("value").alias("value")).collect():
        sums[r["slot"]] += r["value"] << (_LIMB * r["limb"])
    return sums


def _fitting(z: np.ndarray, most: int) -> np.ndarray:
    """``z``, as Python integers unless sums of ``len(z)`` squares of ``most`` fit in 64 bits."""
    return z if len(z) * most * most < 1 << 62 else z.astype(object)


def _column_sums(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max()) if x.size else 0
    return x.sum(0) if len(x) * most < 1 << 62 else x.astype(object).sum(0)


def _squares(s: np.ndarray) -> np.ndarray:
    return (s * s).sum(0) if s.dtype == object else np.einsum("ij,ij->j", s, s)


def polarised_squares(z: np.ndarray) -> np.ndarray:
    """Sums of the squares of every column, then of every sum of two columns (i < j, by i)."""
    out = [_squares(z)]
    for i in range(z.shape[1] - 1):
        out.append(_squares(z[:, i + 1 :] + z[:, i : i + 1]))
    return np.concatenate(out)


# ---------------------------------------------------------------- model

@dataclass
class Whitening:
    """Exact moments and the eigenvectors of the covariance, by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray  # one column per component
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def centre(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """What centring on integers leaves of every sum."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre, strict=True)]

    def live(self) -> np.ndarray:
        """Components with variance."""
        top = float(self.values[0]) if len(self.values) else 0.0
        return self.values > max(top, 0.0) * self.width * 1e-14

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """Exact sum over dimensions of ``(n * x - S)**2`` for centred rows ``z``."""
        most = self.n * (int(np.abs(z).max()) + 1 if z.size else 1)
        fits = self.width * most * most < 1 << 62
        rest = np.array(self.rest, np.int64 if fits else object)
        own = (z if fits else z.astype(object)) * self.n - rest
        return (own * own).sum(1)

    def coordinates(self, z: np.ndarray) -> np.ndarray:
        """Whitened coordinates of centred rows (NaN where a component has no variance)."""
        mean = np.array([r / self.n for r in self.rest])
        scale = np.sqrt(np.where(self.live(), self.values, np.nan))
        return (z - mean) @ self.vectors / scale


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """Covariances from exact sums of centred squares; ``rest`` is left of the centred sums."""
    d = len(rest)
    single = [n * squares[i] - rest[i] ** 2 for i in range(d)]  # n**2 times the variances
    out = np.empty((d, d))
    at = d
    for i in range(d):
        out[i, i] = single[i] / (n * n)
        for j in range(i + 1, d):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - single[i] - single[j]) / (2 * n * n)
            at += 1
    return out


def fit(rows: DataFrame, width: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Two passes over the ``n`` vectors ``vec`` of ``width`` entries."""
    sums = exact_sums(rows, width, width, _column_sums)
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]

    def part(x: np.ndarray) -> np.ndarray:
        z = x - centre
        return polarised_squares(_fitting(z, 2 * (int(np.abs(z).max()) if z.size else 0)))

    squares = exact_sums(rows, width * (width + 1) // 2, width, part)
    matrix_ = covariance(n, rest, squares)
    values, vectors = np.linalg.eigh(matrix_)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    # one sign for all rows: the largest entry of a component is positive
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(width)])
    return Whitening(n, sums, matrix_, values[:components], vectors[:, :components], float(np.trace(matrix_)))


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    width, live = model.width, model.live()
    k = int(live.sum())
    if not k:
        return None
    centre = np.array(model.centre, np.int64)

    def run(batches) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.coordinates(integers(matrix(batch.column("vec"), width)) - centre)[:, live]
            total += w.sum(0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + k * k), pa.int32()), pa.array(np.concatenate((total, products.ravel())))], ["slot", "value"])

    found = np.zeros(k + k * k)
    for r in rows.select("vec").mapInArrow(run, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        found[r["slot"]] = r["value"]
    mean = found[:k] / model.n
    return float(np.abs(found[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


# ---------------------------------------------------------------- output

def usable(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    return usable_vectors(table, vector, F.col(id_column).cast("long").alias("vec_id"), limit=LIMIT)


def whiten(table: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: ``vec_id``, ``deviation`` (decimal text of the exact integer), ``whitened``
    (array of ``components`` doubles), and the model's ``n``, ``explained`` and ``identity_error``."""
    spark = table.sparkSession
    rows = usable(table, id_column, vector)
    width, n = usual_length(rows)
    schema = "vec_id long, n long, deviation string, whitened array<double>, explained array<double>, identity_error double"
    if not n or not width:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vec") == width)
    model = fit(rows, width, n, components)
    error = identity_error(rows, model)
    centre = np.array(model.centre, np.int64)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = integers(matrix(batch.column("vec"), width)) - centre
            for at in range(0, len(z), BLOCK):
                own = z[at : at + BLOCK]
                w = model.coordinates(own)
                whitened = pa.array([[None if np.isnan(v) else v for v in r] for r in w.tolist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, len(own)), pa.array([str(int(v)) for v in model.deviations(own)]), whitened],
                    ["vec_id", "deviation", "whitened"],
                )

    out = rows.mapInArrow(run, "vec_id long, deviation string, whitened array<double>")
    numbers = F.array(*[F.lit(e).cast("double") for e in explained])
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", numbers.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def whitening_report(table: DataFrame) -> DataFrame:
    """One row per remaining vector and component; a deviation beyond a long is null
    (``deviation_exact`` has it as text)."""
    rows = whiten(table).select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return rows.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error", F.col("deviation").alias("deviation_exact"),
    )
