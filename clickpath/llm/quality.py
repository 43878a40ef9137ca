"""Quality by ridge regression on random Fourier features.

A pass over whole texts reduces each document to a few statistics (length,
character classes, repetition, vocabulary, lines). They are standardised with
corpus moments, random Fourier features approximate a Gaussian kernel over
them, and the normal equations of the ridge fit are summed per partition and
then over partitions, so every labelled row that may be used takes part and the
driver gets one matrix of fixed size. A fifth of those rows is kept
from the fit for isotonic calibration: label sums per score bin, pooled where
they are not increasing, and interpolated.

Defined results: null and empty texts have zero statistics and get a score
like any other; labels that are null or belong to no document are ignored; if
an id has several labels the largest counts; without labels every score is
0.5; repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import (
    SPACE_WORDS,
    U64,
    byte_chunks,
    byte_table,
    held_out,
    keep_rows,
    materialize,
    mix,
    text_bytes,
    word_hashes,
    words,
)

CHUNK_BYTES = 2 << 20
FOURIER = 256
BINS = 1024
_LINES = byte_table(b"\n")

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r",
    "stop": b".,;:?",
    "shout": b"!",
    "symbol": b"\"#$%&'()*+-/<=>@[\\]^_`{|}~",
    "wide": bytes(range(128, 256)),
}
STATS = [
    "log_bytes", "log_words", *_CLASSES, "word_bytes", "long_words", "distinct_words", "distinct_pairs", "same_as_before",
    "same_as_two_before", "log_lines", "distinct_lines", "top_word",
]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`STATS` per document."""
    docs = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    columns = [np.log1p(size)]
    start, end, first = words(data, offsets, SPACE_WORDS)
    n = np.diff(first).astype(float)
    columns.append(np.log1p(n))
    of_byte = np.repeat(np.arange(docs), np.diff(offsets))
    code = np.zeros(256, np.int64)
    for k, members in enumerate(_CLASSES.values(), 1):
        code[np.frombuffer(members, np.uint8)] = k
    width = len(_CLASSES) + 1
    counts = np.bincount(of_byte * width + code[data], minlength=docs * width).reshape(docs, width)
    columns += [counts[:, k] / some for k in range(1, width)]
    doc = np.repeat(np.arange(docs), np.diff(first))
    length = (end - start).astype(float)
    per_word = lambda flags: np.bincount(doc, weights=flags, minlength=docs) / np.maximum(n, 1)
    columns += [per_word(np.minimum(length, 100)), per_word(length > 20)]
    lowered = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    h = word_hashes(lowered, start, end)
    distinct, most = _distinct(doc, h, docs)
    columns.append(distinct / np.maximum(n, 1))
    same = doc[1:] == doc[:-1]
    pairs, _ = _distinct(doc[1:][same], mix(h[:-1][same] * U64(3) + h[1:][same]), docs)
    columns.append(pairs / np.maximum(n - 1, 1))
    for step in (1, 2):
        flags = np.zeros(len(h))
        flags[step:] = (h[step:] == h[:-step]) & (doc[step:] == doc[:-step])
        columns.append(per_word(flags))
    a, b, lines = words(data, offsets, _LINES)
    n_lines = np.diff(lines).astype(float)
    columns.append(np.log1p(n_lines))
    different, _ = _distinct(np.repeat(np.arange(docs), np.diff(lines)), word_hashes(data, a, b), docs)
    columns.append(different / np.maximum(n_lines, 1))
    columns.append(most / np.maximum(n, 1))
    return np.stack(columns, 1)


def _distinct(doc: np.ndarray, h: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per document, and the count of the most frequent one."""
    if not len(h):
        return np.zeros(docs), np.zeros(docs)
    key = np.sort((doc.astype(U64) << U64(40)) | (h >> U64(24)))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    owner = (key[at] >> U64(40)).astype(np.int64)
    most = np.zeros(docs)
    np.maximum.at(most, owner, np.diff(np.append(at, len(key))))
    return np.bincount(owner, minlength=docs).astype(float), most


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` (see :data:`STATS`) of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [statistics(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in byte_chunks(offsets, CHUNK_BYTES)]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _vectors(np.concatenate(parts))], ["doc_id", "stats"])

    rows = keep_rows(docs, "doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def _vectors(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None = None
    raw: np.ndarray | None = None  # calibration: raw scores and their probabilities
    chance: np.ndarray | None = None

    def expand(self, stats: np.ndarray) -> np.ndarray:
        """Fourier features and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2.0 / len(self.phase)) * np.cos(x @ self.turn + self.phase)
        return np.concatenate((z, np.ones((len(z), 1))), 1)

    def rank(self, stats: np.ndarray) -> np.ndarray:
        """Ridge score, cut to [0, 1]."""
        return np.clip(self.expand(stats) @ self.weights, 0.0, 1.0)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.rank(stats), self.raw, self.chance), 0.0, 1.0)


def pooled(raw: list[float], good: list[float], count: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of bin means: pool neighbours that are not increasing."""
    blocks: list[list[float]] = []
    for x, g, c in zip(raw, good, count, strict=True):
        blocks.append([x * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", fourier: int = FOURIER, ridge: float = 1e-3, width: float = 4.0, seed: int = 7) -> Model:
    """Fit on every labelled row that may be used; ``stats`` should be materialised."""
    k = len(STATS)
    wide = stats.select(*[F.col("stats")[i].alias(f"s{i}") for i in range(k)])
    row = wide.agg(*[F.avg(f"s{i}").alias(f"m{i}") for i in range(k)], *[F.stddev_pop(f"s{i}").alias(f"d{i}") for i in range(k)]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([max(row[f"d{i}"] or 0.0, 1e-6) for i in range(k)])
    rng = np.random.default_rng(seed)
    model = Model(mean, scale, rng.normal(size=(k, fourier)) / width, rng.uniform(0, 2 * np.pi, fourier))
    own = labels.select("doc_id", F.col(label).cast("double").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    # one pass over the small statistics; the calibration fifth is fixed by the id
    rows = stats.join(own, "doc_id").select("stats", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("calibrate"))
    rows = materialize(stats.sparkSession, rows)

    def equations(batches):
        total = np.zeros((fourier + 1, fourier + 2))
        for batch in batches:
            if batch.num_rows:
                z = model.expand(_matrix(batch.column("stats")))
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ batch.column("label").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(fourier + 1), pa.int32()), _vectors(total)], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = _matrix(table.column("row").combine_chunks()).sum(0)
        return pa.table({"i": table.column("i").slice(0, 1), "row": _vectors(total[None])})

    type_ = "i int, row array<double>"
    sums = rows.where("not calibrate").select("stats", "label").mapInArrow(equations, type_).groupBy("i").applyInArrow(add, type_)
    found = {r["i"]: np.array(r["row"]) for r in sums.collect()}  # fourier + 1 rows, whatever the input
    if not found or found[fourier][-2] == 0:
        return model
    total = np.stack([found[i] for i in range(fourier + 1)])
    normal = total[:, :-1] + ridge * total[-1, -2] * np.diag(np.append(np.ones(fourier), 0.0)) / fourier
    model.weights = np.linalg.solve(normal + 1e-9 * np.eye(fourier + 1), total[:, -1])

    def ranks(batches):
        for batch in batches:
            r = model.rank(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(r), batch.column("label")], ["rank", "label"])

    ranked = rows.where("calibrate").select("stats", "label").mapInArrow(ranks, "rank double, label double")
    bins = ranked.groupBy(F.floor(F.col("rank") * (BINS - 1)).alias("bin")).agg(F.avg("rank").alias("raw"), F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"))
    binned = sorted((r["raw"], r["good"], r["n"]) for r in bins.collect())  # at most BINS rows
    if binned:
        model.raw, model.chance = pooled([b[0] for b in binned], [b[1] for b in binned], [b[2] for b in binned])
    else:
        model.raw = model.chance = np.array([0.0, 1.0])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = shared.value.score(_matrix(batch.column("stats"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scores and decisions of all documents."""
    stats = materialize(docs.sparkSession, document_statistics(docs))
    scored = score(stats, fit(stats, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
