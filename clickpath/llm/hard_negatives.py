"""Hard-negative mining with cover trees.

Rows are vectors with a label; their entries become integers, ``floor(scale * entry)``.
The score of a row for an anchor is the integer inner product, ties go to the smaller id.
An anchor's positives are the ``positives`` best other rows of its label. For each of
them, its negatives are the ``negatives`` best rows of other labels whose score lies in
a window of shares of the positive's score. Results are exact.

How it runs: a bounded sample of rows gives the centres of cells by farthest-first
traversal; every row belongs to its nearest centre, and a cell is dealt by hash into
blocks of about ``block_rows``, so a cell or a vector that holds a third of all rows is
many blocks. Every block is built once into a ``CoverTree``, a row of a written table.
Positives and then negatives are searched in two rounds: first each anchor meets the
blocks of its own cell, which gives it bounds; then only those cells whose centre and
covering radius leave room above these bounds and inside the windows. A task takes one
tree and at most about ``anchor_rows`` anchors. Where nothing can be skipped (vectors
without structure) that is all anchors against all rows, in blocks. Equal vectors of one
label in a block are one class with its smallest ids, which is all that a result can
hold of them.

Defined results: rows without id, without label, with a null vector, null or non-finite
entries take no part, nor do vectors whose length is not the commonest one (the larger,
if tied) or with an entry whose integer would exceed 2**40; if an id has several rows the
smallest (vector, label) counts; fewer candidates than wanted give fewer rows; windows of
negative scores are empty; an empty table gives no rows; extra columns are ignored.
Scores that might not fit a long are an error. There is no text; a vector of any
length is one row of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm.common import materialize
from clickpath.llm.cover_tree import HIGHEST, LOWEST, CoverTree, augmented, farthest_first, product_bounds
from clickpath.llm.vectors import matrix, usable_vectors, usual_length

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: least and most share of a positive's score, in percent
SHARES = (50, 95)
BLOCK_ROWS = 8192
ANCHOR_ROWS = 8192
#: cells at most, and rows that their centres are taken from
CELLS, SAMPLE_ROWS = 1024, 8192

_FOUND = "anchor_id long, window int, vec_id long, score long"
_FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _integers(column, width: int) -> np.ndarray:
    return matrix(column, width).astype(np.int64)


def _rows(table: DataFrame, id_column: str, label: Column, vector: str, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and integer ``vec``, one row per id."""
    own = usable_vectors(table, vector, F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), limit=float(1 << 40) / scale)
    own = own.where("vec_id IS NOT NULL AND label IS NOT NULL")
    own = own.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("long")))
    one = own.groupBy("vec_id").agg(F.min(F.struct("vec", "label")).alias("r"))
    return one.select("vec_id", "r.label", "r.vec")


class Cells:
    """Centres (augmented), covering radii and blocks of the cells; at most ``CELLS`` of them."""

    def __init__(self, centres: np.ndarray, bound2: float):
        self.centres, self.bound2 = centres, bound2
        self.radius = np.zeros(len(centres))
        self.first = np.zeros(len(centres) + 1, np.int64)  # numbers of the first blocks

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = augmented(vectors, self.bound2)
        apart = np.full(len(points), np.inf)
        own = np.zeros(len(points), np.int64)
        for c, centre in enumerate(self.centres):
            gap = points - centre
            d = np.einsum("ij,ij->i", gap, gap)
            closer = d < apart
            own[closer], apart[closer] = c, d[closer]
        return own, np.sqrt(apart)


def _cells(rows: DataFrame, n: int, width: int, bound2: float, block_rows: int) -> Cells:
    most = min(CELLS, -(-n // block_rows))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE_ROWS, 64 * most)).select("vec").collect()
    points = augmented(np.array([r["vec"] for r in sample], np.int64).reshape(-1, width), bound2)
    centres, _, _ = farthest_first(points, most)
    return Cells(points[centres], bound2)


def _placed(rows: DataFrame, cells: Cells, width: int) -> DataFrame:
    """``rows`` with their cell and their distance from its centre."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, apart = cells.nearest(_integers(batch.column("vec"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(apart)], [*batch.schema.names, "cell", "apart"])

    return rows.mapInArrow(run, "vec_id long, label long, vec array<long>, cell int, apart double")


def _trees(placed: DataFrame, cells: Cells, width: int, block_rows: int, wanted: int) -> DataFrame:
    """``block`` and ``tree``, and the cells' radii and block numbers filled in."""
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("apart").alias("radius")).collect()  # one row per cell
    slices = np.ones(len(cells.centres), np.int64)
    for r in sizes:
        slices[r["cell"]], cells.radius[r["cell"]] = -(-r["n"] // block_rows), r["radius"]
    cells.first[1:] = np.cumsum(slices)
    at = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("cell") + 1)
    block = at(cells.first[:-1]) + F.pmod(F.xxhash64("vec_id"), at(slices))
    bound2 = cells.bound2

    def build(group: pa.Table) -> pa.Table:
        ids, labels = (group.column(c).to_numpy() for c in ("vec_id", "label"))
        vectors = _integers(group.column("vec"), width)
        order = np.lexsort((ids, labels, *vectors.T))  # classes of equal vectors and labels, by id
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (labels[1:] != labels[:-1]) | (vectors[1:] != vectors[:-1]).any(1)
        start = np.flatnonzero(new)
        few = np.arange(len(ids)) - start[np.cumsum(new) - 1] < wanted
        tree = CoverTree.build(ids[few], labels[few], vectors[few], bound2)
        return pa.table({"block": group.column("block").slice(0, 1), "tree": pa.array([tree.to_bytes()], pa.large_binary()).cast(pa.binary())})

    return placed.select("vec_id", "label", "vec", block.alias("block")).groupBy("block").applyInArrow(build, "block long, tree binary")


class _Search:
    """One search: anchors with windows against the trees, cells that can't matter left out."""

    def __init__(self, trees: DataFrame, cells: Cells, width: int, parts: int, k: int, same: bool, windows):
        self.trees, self.cells, self.width, self.parts, self.k, self.same, self.windows = trees, cells, width, parts, k, same, windows

    def visits(self, anchors: DataFrame, home: bool) -> DataFrame:
        """A row for every block that an anchor has to meet: those of its own cell, or of the others."""
        cells, width, windows = self.cells, self.width, self.windows

        def run(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("cell").to_numpy()
                if home:
                    met = np.arange(len(cells.centres))[:, None] == own[None, :]
                else:
                    low, high = product_bounds(cells.centres, cells.radius, matrix(batch.column("vec"), width).astype(np.float64), cells.bound2)
                    least, most = windows(batch)
                    met = np.zeros(low.shape, bool)
                    for w in range(least.shape[1]):
                        met |= (high >= least[None, :, w]) & (low <= most[None, :, w]) & (least <= most)[None, :, w]
                    met &= np.arange(len(cells.centres))[:, None] != own[None, :]
                cell, row = np.nonzero(met)
                count = cells.first[cell + 1] - cells.first[cell]
                row = np.repeat(row, count)
                block = np.repeat(cells.first[cell] - (np.cumsum(count) - count), count) + np.arange(len(row))
                for a in range(0, len(row), 4096):
                    part = batch.take(pa.array(row[a : a + 4096]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(block[a : a + 4096])], [*part.schema.names, "block"])

        schema = ", ".join(f"{c} {t}" for c, t in anchors.dtypes) + ", block long"
        return anchors.mapInArrow(run, schema).withColumn("part", F.pmod(F.xxhash64("anchor_id", F.lit(5)), F.lit(self.parts)).cast("int"))

    def found(self, visits: DataFrame) -> DataFrame:
        width, k, same, windows = self.width, self.k, self.same, self.windows

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.Table.from_pylist([], schema=_FOUND_ARROW)
            tree = CoverTree.from_bytes(left.column("tree")[0].as_py())
            ids, labels = (right.column(c).to_numpy() for c in ("anchor_id", "label"))
            low, high = windows(right)
            query, window, vec_id, score = tree.search(ids, labels, _integers(right.column("vec"), width), low, high, k, same)
            return pa.table([pa.array(ids[query]), pa.array(window, pa.int32()), pa.array(vec_id), pa.array(score)], schema=_FOUND_ARROW)

        copies = self.trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        found = copies.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInArrow(run, _FOUND)
        best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def best(self, anchors: DataFrame, floors) -> DataFrame:
        """``anchor_id``, ``window``, ``rank``, ``vec_id``, ``score``. ``floors`` adds to the anchors
        what the first round found of them."""
        spark = anchors.sparkSession
        first = materialize(spark, self.found(self.visits(anchors, home=True)).drop("rank"))
        if len(self.cells.centres) == 1:
            both = first
        else:
            both = first.unionByName(self.found(self.visits(floors(anchors, first), home=False)).drop("rank"))
        best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)


def _lists(column) -> list:
    return column.to_pylist()


def _floor_rows(anchors: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Anchors with ``floors``: the k-th best score per window, where there are k."""
    kth = first.groupBy("anchor_id", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    kth = kth.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("found"))
    kth = kth.withColumnRenamed("anchor_id", "found_id")
    out = anchors.drop("floors").join(kth, F.col("anchor_id") == F.col("found_id"), "left")
    return out.select(*anchors.drop("floors").columns, F.transform(F.sequence(F.lit(0), F.lit(15)), lambda w: F.col("found")[w]).alias("floors"))


def _positive_windows(batch):
    floors = [(f or [None])[0] for f in _lists(batch.column("floors"))]
    low = np.array([LOWEST if f is None else f for f in floors], np.int64)[:, None]
    return low, np.full_like(low, HIGHEST)


def _negative_windows(shares: tuple[int, int], positives: int):
    def windows(batch):
        scores = _lists(batch.column("scores"))
        low = np.full((len(scores), positives), 1, np.int64)
        high = np.zeros((len(scores), positives), np.int64)  # empty
        for i, (own, floors) in enumerate(zip(scores, _lists(batch.column("floors")), strict=True)):
            for w, p in enumerate(own):
                low[i, w], high[i, w] = -(-shares[0] * p // 100), shares[1] * p // 100
                if floors and floors[w] is not None and low[i, w] <= high[i, w]:
                    low[i, w] = max(int(low[i, w]), floors[w])
        return low, high

    return windows


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    label: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = SHARES,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score``
    for the rows that ``is_anchor`` (a condition on ``vec_id``) holds for; at most 16 positives."""
    if not 1 <= positives <= 16 or negatives < 1:
        raise ValueError("from 1 to 16 positives, and one negative at least, are searched")
    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long"
    rows = materialize(spark, _rows(table, id_column, label, vector, scale))
    width, n = usual_length(rows)
    if not n or not width:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vec") == width)
    norm2 = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    asked, longest2 = rows.agg(F.sum(is_anchor.cast("long")), F.max(norm2)).first()
    if not asked:
        return spark.createDataFrame([], schema)
    bound2 = longest2 * (1 + 1e-9) + 1
    if bound2 >= 1 << 62:
        raise ValueError("inner products might not fit in a long: use a smaller scale")
    cells = _cells(rows, n, width, bound2, block_rows)
    placed = materialize(spark, _placed(rows, cells, width))
    trees = materialize(spark, _trees(placed, cells, width, block_rows, max(positives, negatives) + 1))
    parts = -(-asked // anchor_rows)
    none = F.lit(None).cast("array<long>").alias("floors")
    anchors = placed.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vec", "cell", none)

    search = _Search(trees, cells, width, parts, positives, True, _positive_windows)
    found = materialize(spark, search.best(anchors, lambda a, f: _floor_rows(a, f, positives)))
    own = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("own"))
    own = own.select(F.col("anchor_id").alias("own_id"), F.col("own.score").alias("scores"))
    asking = materialize(spark, anchors.join(own, F.col("anchor_id") == F.col("own_id")).drop("own_id"))

    search = _Search(trees, cells, width, parts, negatives, False, _negative_windows(shares, positives))
    mined = search.best(asking, lambda a, f: _floor_rows(a, f, negatives))
    mined = mined.select("anchor_id", (F.col("window") + 1).alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = found.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(found, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"
    )


def mining_report(table: DataFrame) -> DataFrame:
    """Hard negatives of every row whose id is divisible by 50; where an id is divisible by 7 its label moves on."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(table, F.col("vec_id") % 50 == 0, label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
