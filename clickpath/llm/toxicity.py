"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct hashes (32 bits) of its words, word pairs
and skip-grams (words with one word between them), lower-cased. Training takes
all labelled rows that may be used, dealt by a hash of the id into
shards of about ``shard_rows`` labels; each shard runs per-coordinate
FTRL with L1 and L2 terms in its own task, and the shards' weights are
averaged. L1 leaves few non-zero weights in a shard, so the model is small enough to
broadcast. L1 also shrinks margins, so
a fifth of those rows is kept from training and stretches them to
probabilities (a logistic curve of two parameters, each step of its fit one sum over
their margins). All rows are scored in one narrow pass over whole texts.

Defined results: null and empty texts have no features and get the score of
the bias alone; labels that are null or belong to no document are ignored; if
an id has several labels the largest counts; without labels every score is
0.5; repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from clickpath.llm.common import (
    U64,
    byte_chunks,
    byte_table,
    extended,
    held_out,
    keep_rows,
    materialize,
    mix,
    released,
    released_group,
    remove_table,
    text_bytes,
    word_hashes,
    words,
    write_table,
)

#: labels of one shard, each trained in its own task
SHARD_ROWS = 4_000
#: labels that are broadcast at most; more of them meet the texts in a shuffle
BROADCAST_LABELS = 1 << 18
CHUNK_BYTES = 2 << 20

# word bytes: digits, letters and everything that is not ASCII
_FLAGS = byte_table(bytes(c for c in range(128) if not chr(c).isalnum()))


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate FTRL-proximal settings."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.01
    epochs: int = 10
    positive: float = 3.0  # weight of a toxic row
    least_rows: int = 3  # features of fewer rows are left out


def lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of all word, pair and skip-gram occurrences of a chunk."""
    data = lower(data)
    start, end, first = words(data, offsets, _FLAGS)
    h = word_hashes(data, start, end)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out_doc, out = [doc], [mix(h)]
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = doc[step:] == doc[:-step]
        out_doc.append(doc[step:][same])
        out.append(mix(h[:-step][same] * U64(factor) + h[step:][same]))
    return np.concatenate(out_doc), (np.concatenate(out) >> U64(32)).astype(np.uint32)


def distinct_features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    doc, feature = features(data, offsets)
    pair = np.unique((doc.astype(U64) << U64(32)) | feature)
    cuts = np.searchsorted(pair, np.arange(len(offsets), dtype=U64) << U64(32))
    return [pair[a:b].astype(np.uint32) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _places(known: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places in ``known`` of the features that are there."""
    at = np.searchsorted(known, features)
    at = at[at < len(known)] if len(known) == 0 else np.minimum(at, len(known) - 1)
    return at[known[at] == features] if len(known) else at


def train(rows: list[tuple[np.ndarray, int]], settings: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL over (features, label) rows: (features, weights) that are not zero, and the bias."""
    if not rows:
        return np.zeros(0, np.uint32), np.zeros(0), 0.0
    s = settings
    known, count = np.unique(np.concatenate([f for f, _ in rows]), return_counts=True)
    known = known[count >= s.least_rows]
    bias = len(known)  # the last coordinate, without L1
    l1 = np.full(bias + 1, s.l1)
    l1[bias] = 0.0
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    coded = [np.append(_places(known, f), bias) for f, _ in rows]

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1[i]) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= l1[i], 0.0, w)

    for _ in range(s.epochs):
        for i, (_, label) in zip(coded, rows, strict=True):
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            g *= s.positive if label else 1.0
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha * w
            n[i] += g * g
    w = weights(np.arange(bias + 1))
    used = np.flatnonzero(w[:bias])
    return known[used], w[used], float(w[bias])


@dataclass
class Model:
    """Sparse weights by feature hash."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    stretch: float = 1.0
    shift: float = 0.0

    def scorer(self, margins: bool = False):
        """A function of (bytes, offsets) → score (or margin) per document."""
        maybe = np.zeros(1 << 20, bool)  # first look: is any key near this hash?
        maybe[self.keys >> np.uint32(12)] = True

        def score(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            doc, feature = features(data, offsets)
            near = np.flatnonzero(maybe[feature >> np.uint32(12)])
            doc, feature = doc[near], feature[near]
            at = np.searchsorted(self.keys, feature)
            at = np.minimum(at, max(len(self.keys) - 1, 0))
            hit = self.keys[at] == feature if len(self.keys) else np.zeros(0, bool)
            pair, first = np.unique((doc[hit].astype(U64) << U64(32)) | feature[hit], return_index=True)
            total = np.bincount((pair >> U64(32)).astype(np.int64), weights=self.weights[at[hit][first]], minlength=len(offsets) - 1)
            total = total + self.bias
            return total if margins else logistic(self.stretch * total + self.shift)

        return score


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def stretch(rows: DataFrame, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a logistic curve from margins (``score``) to ``label`` by Newton
    steps, each of them one sum over ``rows``."""
    if rows.select("label").distinct().limit(2).count() < 2:
        return 1.0, 0.0
    x, w = F.col("score"), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + F.exp(-F.least(F.greatest(x * float(w[0]) + float(w[1]), F.lit(-30.0)), F.lit(30.0))))
        off, bend = p - F.col("label"), p * (1.0 - p)
        sums = rows.agg(*[F.sum(v) for v in (off * x, off, bend * x * x, bend * x, bend)]).first()
        gradient = np.array(sums[:2]) + ridge * (w - [1.0, 0.0])
        step = np.linalg.solve(np.array([sums[2:4], sums[3:5]]) + ridge * np.eye(2), gradient)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """``(doc_id, label)`` of all ids that training may use."""
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return own.groupBy("doc_id").agg(F.max("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", shard_rows: int = SHARD_ROWS, settings: Ftrl = Ftrl()) -> Model:
    """Train on all labels that may be used; the driver gets the averaged non-zero weights."""
    spark = docs.sparkSession
    known = materialize(spark, training_labels(labels, label))
    n = known.count()
    shards = max(1, -(-n // shard_rows))
    texts = keep_rows(docs, "doc_id", "text")
    if n <= BROADCAST_LABELS:
        known = F.broadcast(known)
    elif docs.schema["doc_id"].dataType == labels.schema["doc_id"].dataType:
        texts = texts.where(~held_out())  # these have no label here, and need not be shuffled
    picked = texts.join(known, "doc_id")
    h = F.xxhash64("doc_id", F.lit(1))
    picked = picked.select("doc_id", "label", "text", F.pmod(h, F.lit(shards)).cast("int").alias("shard"), (F.pmod(F.shiftright(h, 20), F.lit(5)) == 0).alias("calibrate"))
    picked, path = write_table(spark, picked, "labelled")
    model = _averaged(picked, settings)
    if model is not None:
        margins = score(picked.where("calibrate"), model, ("label",), margins=True)
        model.stretch, model.shift = stretch(materialize(spark, margins))
    remove_table(spark, path)
    return model or Model()


def _averaged(picked: DataFrame, settings: Ftrl) -> Model | None:
    """Mean of the weights of all shards, if they have rows."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        data, offsets = text_bytes(table.column("text"))
        found = []
        for lo, hi in byte_chunks(offsets, CHUNK_BYTES):
            found += distinct_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        order = np.random.default_rng(0).permutation(len(found))
        y = table.column("label").to_numpy()
        keys, weights, bias = train([(found[i], int(y[i])) for i in order], settings)
        return pa.table({"feature": pa.array([*keys.tolist(), -1], pa.int64()), "weight": pa.array([*weights.tolist(), bias], pa.float64())})

    parts = picked.where("not calibrate").groupBy("shard").applyInArrow(released_group(run), "feature long, weight double")
    found = parts.groupBy("feature").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).toArrow().sort_by("feature")
    if not found.num_rows:
        return None
    feature, weight = found.column("feature").to_numpy(), found.column("weight").to_numpy()
    used = found.column("n")[0].as_py()  # feature -1 is the bias, one of every shard with rows
    return Model(feature[1:].astype(np.uint32), weight[1:] / used, float(weight[0] / used))


_models: dict[str, object] = {}


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), margins: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``score``: one narrow pass over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    rows = keep_rows(docs, *dict.fromkeys((*keep, "text")))

    def run(batches):
        if key not in _models:
            _models.clear()
            _models[key] = shared.value.scorer(margins)
        scorer = _models[key]
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [scorer(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in byte_chunks(offsets, CHUNK_BYTES)]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores)], [*keep, "score"])

    return rows.mapInArrow(released(run), extended(rows, keep, StructField("score", DoubleType())))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Scores and decisions of all documents."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
