"""Mixing sources to target weights by iterative proportional fitting.

One pass over whole texts gives every document its number of tokens (words) and its
topic. Tokens are summed per cell (source, language, topic). A round scales
every source to its target, then the languages, then the topics, until no share is
further than ``tolerance`` from its target or the error no longer falls (targets that
contradict each other can't be met). The weight of a cell is the product of its factors.
Documents are then kept with probability ``min(1, scale * weight)``, where the scale is
calibrated so that the expected number of tokens is the wanted share.

Sources may be as many as the rows: each is one row that holds its (language, topic)
cells, and a round is one pass that sends the sum of every (language, topic) pair to
the driver. With more than ``PAIRS`` pairs nothing but the error goes there: each
marginal then has a table with one factor per value, and a step joins the cells with the
factors of the other two and sums them per value. Both ways are exact; the second
takes more jobs.

Targets are shares per value; a marginal without given targets is flattened: its shares
are raised to the power ``temper`` and normalised. Values missing from given targets get
weight 0. The draw is a hash of the id and a seed, so it repeats.

Topics come from a column, if one is named. Else they are clusters of vocabulary: hashed
words of ``LONG_WORD`` bytes or more, weighted by rarity, of all texts are grouped by
spherical k-means into ``TOPICS`` centres, and every text belongs to the centre nearest to
its words, the smaller number if tied, or to the last one if it has no such word. The texts
are read once for it: their counts per hashed place are a written table, and the rarity, each
first centre and each round of the k-means are one pass over that table. Vectors lie on
a grid on which products and sums are exact, so the order of rows and tasks does not matter.

Defined results: null sources, languages and topics are values of their own; null and
empty texts have no tokens, and are drawn like others of their cell; the weight of a cell
without tokens is 1; a null id is drawn as one id; repeated rows are drawn alike; an empty
table gives no rows; extra columns are kept. Long texts are counted whole; a task holds
one Arrow batch of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField

from clickpath.llm.common import (
    SPACE_WORDS,
    byte_chunks,
    extended,
    materialize,
    packed,
    released,
    remove_table,
    text_bytes,
    word_hashes,
    words,
    write_table,
)

TOPICS = 8
LONG_WORD = 5
SHARE = 0.5
TEMPER = 0.5
ROUNDS = 100
#: hashed word places
PLACES = 512
#: steps of a unit vector's entries: a product of two vectors is a multiple of 2**-52 near 1 at most
GRID = 1 << 26
#: texts whose words are counted together at most
BLOCK_TEXTS = 512
_BINS = 4096
#: (language, topic) pairs whose sums may come to the driver
PAIRS = 1 << 16
MARGINALS = ("mix_source", "mix_lang", "mix_topic")


# ---------------------------------------------------------------- topics

def _blocks(column):
    """Numbers of the first and the last text of small blocks, their words, and their long words per hashed place."""
    data, offsets = text_bytes(column)
    for lo, hi in byte_chunks(offsets, 1 << 20):
        for a in range(lo, hi, BLOCK_TEXTS):
            b = min(hi, a + BLOCK_TEXTS)
            yield a, b, *_place_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _place_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of every text, and of its long words per hashed place."""
    start, end, first = words(data, offsets, SPACE_WORDS)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    long_ = end - start >= LONG_WORD
    place = (word_hashes(data, start[long_], end[long_]) % np.uint64(PLACES)).astype(np.int64)
    return n, np.bincount(doc[long_] * PLACES + place, minlength=len(n) * PLACES).reshape(len(n), PLACES)


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, or left zero, and rounded to the grid."""
    return np.rint(v * (GRID / np.maximum(np.sqrt((v * v).sum(1)), 1e-300))[:, None]) / GRID


@dataclass
class Topics:
    """Rarity weights of the hashed words and unit centres."""

    rarity: np.ndarray
    centres: np.ndarray

    def products(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector of every text, and its products with the centres."""
        v = _unit(np.sqrt(counts) * self.rarity)
        return v, v @ self.centres.T

    def of(self, counts: np.ndarray) -> np.ndarray:
        last = len(self.centres) - 1
        return np.where(counts.any(1), self.products(counts)[1].argmax(1), last)


def _pack_counts(counts: np.ndarray) -> pa.Array:
    """Counts of every text, of one byte each if they fit, else of four."""
    narrow, wide = counts.astype(np.uint8), counts.astype("<u4")
    return pa.array([(w if high else n).tobytes() for n, w, high in zip(narrow, wide, (counts > 255).any(1).tolist(), strict=True)], pa.binary())


def _count_blocks(batch: pa.RecordBatch):
    """Counts of a few texts at a time."""
    for a in range(0, batch.num_rows, BLOCK_TEXTS):
        data, offsets = text_bytes(batch.column("counts").slice(a, BLOCK_TEXTS))
        size = np.diff(offsets)
        wide = size > PLACES
        inside = np.repeat(wide, size)
        counts = np.empty((len(size), PLACES), np.int64)
        counts[~wide] = data[~inside].reshape(-1, PLACES)
        counts[wide] = np.frombuffer(data[inside].tobytes(), "<u4").reshape(-1, PLACES)
        yield counts


def _totals(rows: DataFrame, size: int, found) -> np.ndarray:
    """Sums over all texts of the ``size`` whole numbers that ``found`` gives for a block of counts."""

    def part(batches):
        out = np.zeros(size, np.int64)
        for batch in batches:
            for counts in _count_blocks(batch):
                out += found(counts)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(out[some])], ["at", "v"])

    out = np.zeros(size, np.int64)
    for r in rows.select("counts").mapInArrow(released(part), "at int, v long").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out


def _most_apart(rows: DataFrame, model: Topics) -> np.ndarray:
    """Unit vector of the text least like all centres, that with the smallest hash if tied."""

    def apart(batches):
        for batch in batches:
            if batch.num_rows:
                near = np.concatenate([model.products(counts)[1].max(1) for counts in _count_blocks(batch)])
                at = pa.array(np.lexsort((batch.column("h").to_numpy(), near))[:1])
                yield pa.RecordBatch.from_arrays([pa.array(near).take(at), *(batch.column(c).take(at) for c in ("h", "counts"))], ["near", "h", "counts"])

    first = rows.mapInArrow(released(apart), "near double, h long, counts binary").orderBy("near", "h", "counts").limit(1).toArrow()
    counts = next(_count_blocks(first.combine_chunks().to_batches()[0]))
    return model.products(counts)[0][0]


def fit_topics(docs: DataFrame, topics: int = TOPICS, sample_rows: int | None = None, rounds: int = 20) -> Topics:
    """Spherical k-means over all texts, or over ``sample_rows`` of them (those with the smallest hashes of id and text)."""
    own = docs.select(F.xxhash64(docs["doc_id"].cast("string"), docs["text"].cast("string")).alias("h"), docs["text"].cast("string").alias("text"))

    def count(batches):
        for batch in batches:
            for a, b, _, counts in _blocks(batch.column("text")):
                some = np.flatnonzero(counts.any(1))
                yield pa.RecordBatch.from_arrays([batch.column("h").slice(a, b - a).take(pa.array(some)), _pack_counts(counts[some])], ["h", "counts"])

    counted = own.mapInArrow(released(count), "h long, counts binary")
    if sample_rows is not None:
        counted = counted.orderBy("h").limit(sample_rows)
    rows, path = write_table(docs.sparkSession, counted, "vocabulary")
    model = _clustered(rows, topics, rounds)
    remove_table(docs.sparkSession, path)
    return model


def _clustered(rows: DataFrame, topics: int, rounds: int) -> Topics:
    """Rarities and centres of the counted texts ``rows``: ``h`` and ``counts``."""
    seen = _totals(rows, PLACES + 1, lambda counts: np.append((counts > 0).sum(0), len(counts)))
    rarity = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 0.1
    model = Topics(rarity, np.zeros((topics, PLACES)))
    if not seen[-1]:
        return model
    for k in range(topics):  # the text least like all centres so far is the next; none is like a zero centre
        model.centres[k] = _most_apart(rows, model)

    def sums(counts):
        v, near = model.products(counts)
        own = np.arange(topics)[:, None] == near.argmax(1)
        return np.rint(own.astype(float) @ v * GRID).astype(np.int64).ravel()

    for _ in range(rounds):
        total = _totals(rows, topics * PLACES, sums).reshape(topics, PLACES).astype(float)
        moved = np.where(total.any(1)[:, None], _unit(total), model.centres)
        if np.array_equal(moved, model.centres):
            break
        model.centres = moved
    return model


# ---------------------------------------------------------------- documents and cells

_COLUMNS = ["doc_id", "source", "lang", "text"]


def _key(column):
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def describe(docs: DataFrame, topics: Topics | str | None = None, keep_rows: bool = True) -> DataFrame:
    """``doc_id``, ``mix_tokens`` and the values ``mix_source``, ``mix_lang``, ``mix_topic`` (text) of every
    row, and all its columns as the struct ``row`` if they are wanted. ``topics`` is a model (fitted
    on ``docs`` by default) or the name of the column that holds them."""
    model = fit_topics(docs) if topics is None else topics
    named = isinstance(model, str)

    def run(batches):
        for batch in batches:
            tokens, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, n, counts in _blocks(batch.column("text")):
                tokens.append(n)
                found.append(np.zeros(len(n), np.int64) if named else model.of(counts))
            kept = [n for n in batch.schema.names if n != "text"]
            arrays = [*(batch.column(n) for n in kept), pa.array(np.concatenate(tokens).astype(np.int64)), pa.array(np.concatenate(found).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "mix_tokens", "mix_topic"])

    rows = packed(docs, *_COLUMNS) if keep_rows else docs.select(*[docs[c] for c in _COLUMNS])
    if named:
        topic = _key(docs[model]).alias("mix_named")
        rows = docs.select(*([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep_rows else []), *[docs[c] for c in _COLUMNS], topic)
    kept = [c for c in rows.columns if c != "text"]
    out = rows.mapInArrow(released(run), extended(rows, kept, StructField("mix_tokens", LongType()), StructField("mix_topic", IntegerType())))
    out = out.withColumn("mix_topic", F.col("mix_named") if named else _key(F.col("mix_topic")))
    return out.withColumn("mix_source", _key(F.col("source"))).withColumn("mix_lang", _key(F.col("lang"))).drop("mix_named")


@dataclass
class Mix:
    """Weights of the fit per cell, the scale of the draw and the largest difference of a share from its target."""

    cells: DataFrame  # mix_source, mix_lang, mix_topic, tokens, weight
    scale: float
    error: float


def _targets(spark, cells: DataFrame, marginal: str, given, temper: float) -> DataFrame:
    """``value`` and ``target``: shares that add up to 1 over the values that have tokens."""
    mass = cells.where("tokens > 0").groupBy(F.col(marginal).alias("value")).agg(F.sum("tokens").alias("mass"))
    if given is None:
        wanted = mass.select("value", F.pow("mass", F.lit(float(temper))).alias("target"))
    else:
        if isinstance(given, dict):
            given = spark.createDataFrame([(None if v is None else str(v), float(t)) for v, t in given.items()], "value string, target double")
        given = given.toDF("value", "target").select(_key(F.col("value")).alias("value"), F.col("target").cast("double").alias("target"))
        given = given.groupBy("value").agg(F.sum("target").alias("target"))
        wanted = mass.join(given, "value", "left").select("value", F.coalesce("target", F.lit(0.0)).alias("target"))
    wanted = materialize(spark, wanted)
    total = wanted.agg(F.sum("target")).first()[0]
    return wanted.withColumn("target", F.col("target") / F.lit(total)) if total else wanted.withColumn("target", F.lit(0.0))


def _ended(errors: list[float], tolerance: float) -> bool:
    return errors[-1] <= tolerance or (len(errors) > 5 and errors[-1] > 0.98 * errors[-6])


def _rake_pairs(shares: DataFrame, targets: dict[str, DataFrame], tolerance: float, rounds: int) -> tuple[DataFrame, float]:
    """Factors of the cells, with the pairs' sums at the driver: ``mix_*`` and ``found``."""
    spark = shares.sparkSession
    pairs = [(r[0], r[1]) for r in shares.select("mix_lang", "mix_topic").distinct().orderBy("mix_lang", "mix_topic").collect()]
    langs, topics = (sorted({p[k] for p in pairs}) for k in (0, 1))
    places = [{v: i for i, v in enumerate(values)} for values in (langs, topics)]
    lang, topic = (np.array([places[k][p[k]] for p in pairs]) for k in (0, 1))
    wanted = []
    for marginal, values in zip(MARGINALS[1:], (langs, topics), strict=True):
        known = {r["value"]: r["target"] for r in targets[marginal].collect()}
        wanted.append(np.array([known[v] for v in values]))
    numbered = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "mix_lang string, mix_topic string, pair int")
    own = shares.join(numbered, ["mix_lang", "mix_topic"]).groupBy("mix_source")
    own = own.agg(F.collect_list("pair").alias("pair"), F.collect_list("tokens").alias("tokens"))  # at most one entry per pair
    sources = targets["mix_source"].withColumnRenamed("value", "mix_source")
    rows = materialize(spark, own.join(sources, "mix_source"))

    def scaled(batch: pa.RecordBatch, factor: np.ndarray):
        """Place of every entry's row, its pair, its tokens and its source's factor."""
        sizes = np.diff(batch.column("pair").offsets.to_numpy())
        pair, tokens = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pair", "tokens"))
        row = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.bincount(row, weights=tokens * factor[pair], minlength=len(sizes))
        source = np.divide(batch.column("target").to_numpy(), inside, out=np.zeros(len(inside)), where=inside > 0)
        return row, pair, tokens, source

    def sums(factor: np.ndarray) -> np.ndarray:
        def part(batches):
            out = np.zeros(len(factor))
            for batch in batches:
                row, pair, tokens, source = scaled(batch, factor)
                out += np.bincount(pair, weights=tokens * source[row], minlength=len(out))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out)), pa.int32()), pa.array(out)], ["pair", "v"])

        out = np.zeros(len(factor))
        for r in rows.select("pair", "tokens", "target").mapInArrow(part, "pair int, v double").groupBy("pair").agg(F.sum("v").alias("v")).collect():
            out[r["pair"]] = r["v"]
        return out

    factors = [np.ones(len(langs)), np.ones(len(topics))]
    errors: list[float] = []
    for _ in range(rounds):
        before = factors[0][lang] * factors[1][topic]
        mass, error = sums(before), 0.0
        for m, place, other in ((0, lang, topic), (1, topic, lang)):
            now = np.bincount(place, weights=mass * factors[1 - m][other], minlength=len(wanted[m]))
            error = max(error, float(np.abs(now * factors[m] - wanted[m]).max()))
            factors[m] = np.divide(wanted[m], now, out=np.zeros(len(now)), where=now > 0)
        errors.append(error)
        if _ended(errors, tolerance):
            break
    after = factors[0][lang] * factors[1][topic]

    def weigh(batches):
        for batch in batches:
            row, pair, _, source = scaled(batch, before)
            names = batch.column("mix_source").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([names, pa.array(pair, pa.int32()), pa.array(source[row] * after[pair])], ["mix_source", "pair", "found"])

    found = rows.mapInArrow(weigh, "mix_source string, pair int, found double")
    return found.join(numbered, "pair").select(*MARGINALS, "found"), errors[-1]


def _weighted(cells: DataFrame, factors: dict[str, DataFrame], but: str | None = None) -> DataFrame:
    """Cells with the product of the factors of all marginals but one as ``product``."""
    product = F.lit(1.0)
    for m, f in factors.items():
        if m != but:
            own = f.select(F.col("value").alias(m), F.col("factor").alias(f"factor_{m}"))
            cells, product = cells.join(own, m), product * F.col(f"factor_{m}")
    return cells.withColumn("product", product)


def _rake_tables(shares: DataFrame, targets: dict[str, DataFrame], tolerance: float, rounds: int) -> tuple[DataFrame, float]:
    """The same with a factor table per marginal."""
    spark = shares.sparkSession
    factors = {m: t.select("value", F.lit(1.0).alias("factor")) for m, t in targets.items()}
    errors: list[float] = []
    for _ in range(rounds):
        error = 0.0
        for m in MARGINALS:
            sums = _weighted(shares, factors, m).groupBy(F.col(m).alias("value")).agg(F.sum(F.col("tokens") * F.col("product")).alias("now"))
            step = targets[m].join(sums, "value").join(factors[m].withColumnRenamed("factor", "before"), "value")
            step = step.select(
                "value", F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0).alias("factor"),
                F.abs(F.col("now") * F.col("before") - F.col("target")).alias("gap"),
            )
            step = materialize(spark, step)
            if m != MARGINALS[0]:
                error = max(error, step.agg(F.max("gap")).first()[0])
            factors[m] = step.select("value", "factor")
        errors.append(error)
        if _ended(errors, tolerance):
            break
    return _weighted(shares, factors).select(*MARGINALS, F.col("product").alias("found")), errors[-1]


def fit(
    described: DataFrame,
    share: float = SHARE,
    temper: float = TEMPER,
    languages=None,
    topics=None,
    sources=None,
    tolerance: float = 1e-6,
    rounds: int = ROUNDS,
    pairs: int = PAIRS,
) -> Mix:
    """Rake the tokens of ``described`` rows. ``sources``, ``languages`` and ``topics`` are targets, as a
    dict or as a table (value, target) of any size."""
    spark = described.sparkSession
    cells = described.groupBy(*MARGINALS).agg(F.sum("mix_tokens").cast("double").alias("tokens"))
    cells = materialize(spark, cells)
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return Mix(cells.withColumn("weight", F.lit(1.0)), share, 0.0)
    shares = cells.where("tokens > 0").withColumn("tokens", F.col("tokens") / F.lit(total))
    given = dict(zip(MARGINALS, (sources, languages, topics), strict=True))
    targets = {m: _targets(spark, cells, m, given[m], temper) for m in MARGINALS}
    few = shares.select("mix_lang", "mix_topic").distinct().limit(pairs + 1).count() <= pairs
    found, error = (_rake_pairs if few else _rake_tables)(shares, targets, tolerance, rounds)
    weight = F.when(F.col("tokens") > 0, F.col("found")).otherwise(1.0)
    fitted = cells.join(found, list(MARGINALS), "left").select(*MARGINALS, "tokens", weight.alias("weight"))
    fitted = materialize(spark, fitted, spread=True)
    return Mix(fitted, _calibrated(fitted, share * total), float(error))


def _calibrated(cells: DataFrame, wanted: float) -> float:
    """Scale at which ``sum(tokens * min(1, scale * weight))`` is ``wanted``; the weights' distribution comes in
    bins of equal width on a log scale."""
    bin_ = F.least(F.lit(_BINS - 1), F.greatest(F.lit(0), F.round((F.log2("weight") + 32) * (_BINS // 64)).cast("int")))
    own = cells.where("tokens > 0 AND weight > 0").groupBy(bin_.alias("bin"))
    rows = [(r["t"], r["w"]) for r in own.agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("weight")).alias("w")).collect()]  # at most _BINS rows
    kept = lambda s: sum(min(t, s * w) for t, w in rows)
    low, high = 0.0, 1.0
    if not rows or kept(1e30) <= wanted:
        return 1e30
    while kept(high) < wanted:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if kept(mid) < wanted else (low, mid)
    return high


def draw(described: DataFrame, mix: Mix, seed: int = 17) -> DataFrame:
    """``described`` with ``mix_weight``, ``mix_probability`` and ``mix_kept``."""
    out = described.join(mix.cells.select(*MARGINALS, F.col("weight").alias("mix_weight")), list(MARGINALS), "left")
    out = out.withColumn("mix_weight", F.when(F.col("mix_tokens") > 0, F.coalesce("mix_weight", F.lit(1.0))).otherwise(F.lit(1.0)))
    out = out.withColumn("mix_probability", F.least(F.lit(1.0), F.col("mix_weight") * F.lit(mix.scale)))
    u = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return out.withColumn("mix_kept", u < F.col("mix_probability"))


def topic_number():
    """Number of a fitted topic."""
    return F.substring("mix_topic", 2, 10).cast("int")


def sample(docs: DataFrame, topic_column: str | None = None, **targets) -> DataFrame:
    """The drawn rows of ``docs``, with their columns as the struct ``row`` beside
    ``mix_tokens``, ``mix_topic``, ``mix_weight`` and ``mix_probability``. ``docs`` is read several times."""
    topics = topic_column or fit_topics(docs)
    mix = fit(describe(docs, topics, keep_rows=False), **targets)
    return draw(describe(docs, topics), mix).where("mix_kept").select("row", "mix_tokens", "mix_topic", "mix_weight", "mix_probability")


def mixing_report(docs: DataFrame, topic_column: str | None = None, **targets) -> DataFrame:
    """Weight, probability and decision of every document."""
    described = materialize(docs.sparkSession, describe(docs, topic_column, keep_rows=False))
    drawn = draw(described, fit(described, **targets))
    topic = F.substring("mix_topic", 2, 1 << 20) if topic_column else topic_number()
    return drawn.select(
        "doc_id", "source", "lang", F.when(F.col("mix_topic") != "null", topic).alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_weight").alias("weight"), F.col("mix_probability").alias("probability"), F.col("mix_kept").alias("kept"),
    )
