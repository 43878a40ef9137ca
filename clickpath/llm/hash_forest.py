"""Approximate nearest neighbours with a hash-prefix forest.

Every tree gives a vector a long string of hash bits (signs of random projections) and
keeps the strings in a sorted array, so the vectors that share a prefix with a query are
one range of it. Rows are dealt into blocks of ``block_rows`` by hash; the sorted arrays of
a block are built once and written as one row of an index table, so every row is
indexed and no prefix shared by many rows gathers them in one task.

A search has two rounds. In the first, a query descends in all trees of every block to
its longest prefixes and ascends until at least ``first`` vectors (repeats counted) share
them; they are scored, and the ``k`` best over all blocks give the query a bound. In the
second it ascends one bit at a time in all trees together, down to the prefix length at
which a vector as near as that bound would be missed by all trees with a probability below
``miss``; all vectors of these ranges are candidates. The bound is that of the whole
table, so no block is looked at further than a vector of the result could need. There is
no candidate limit: near neighbours stop the ascent early, nearly random vectors late.
Candidates are scored exactly; where a tenth or more of a block are candidates of a group
of queries, their products come from one matrix product of which the candidates are read.

Inner products become angles by the usual extra coordinate, so vectors of any norm
are allowed. Equal vectors are one class with its ``k + 1`` smallest ids, which is all that
a result can hold of them.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without id and vectors whose length is
not the most frequent one (the larger, if tied), which have no inner product with the others; if an id has several vectors
the smallest counts; ties go to the smaller id; an empty table gives no rows;
extra columns are ignored. There is no text; a vector of any length is one row of a block.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm.common import materialize
from clickpath.llm.vectors import matrix

TREES = 64
BITS = 24
MISS = 0.05
#: vectors per wanted neighbour that share the prefixes of the first round
FIRST = 16
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
#: queries that are scored together
GROUP = 256
#: share of a block from which candidates are read from one matrix product
DENSE = 0.1


class Forest:
    """Sorted arrays of hash strings over the rows of one block."""

    FIELDS = ("vectors", "longest", "trees", "bits", "seed", "order", "strings")

    def __init__(self, **fields):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.longest, self.trees, self.bits, self.seed = float(self.longest), int(self.trees), int(self.bits), int(self.seed)

    @classmethod
    def build(cls, vectors: np.ndarray, longest: float, trees: int = TREES, bits: int = BITS, seed: int = 11) -> Forest:
        longest = max(longest, 1e-300)
        unit = vectors / longest
        last = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(1)))
        strings = _strings(np.concatenate((unit, last[:, None]), 1), trees, bits, seed)
        order = np.argsort(strings, axis=0, kind="stable")
        strings = np.take_along_axis(strings, order, 0)
        return cls(vectors=vectors, longest=longest, trees=trees, bits=bits, seed=seed, order=order.T.astype(np.int32), strings=strings.T.astype(np.int32))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Forest:
        with np.load(io.BytesIO(raw)) as found:
            return cls(**{name: found[name] for name in cls.FIELDS})

    def _ranges(self, strings: np.ndarray, tree: int, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the sorted array of ``tree`` that shares all but the last ``cut`` bits."""
        head = (strings[:, tree] >> cut) << cut
        low = np.searchsorted(self.strings[tree], head, "left")
        return low, np.searchsorted(self.strings[tree], head + (1 << cut), "left")

    def _first_depth(self, strings: np.ndarray, wanted: int) -> np.ndarray:
        """The longest common prefix length at which the ranges of all trees hold ``wanted`` rows."""
        low, high = np.zeros(len(strings), np.int64), np.full(len(strings), self.bits)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ranges = [self._ranges(strings, t, self.bits - mid) for t in range(self.trees)]
            enough = sum(b - a for a, b in ranges) >= wanted
            low, high = np.where(enough, mid, low), np.where(enough, high, mid - 1)
        return low

    def _last_depth(self, cosine: np.ndarray, miss: float) -> np.ndarray:
        """The longest prefix length at which all trees miss a vector at this cosine with at most ``miss``."""
        agree = np.clip(1.0 - np.arccos(np.clip(cosine, -1.0, 1.0)) / np.pi, 1e-12, 1.0 - 1e-12)
        return np.clip(np.floor(np.log(1.0 - miss ** (1.0 / self.trees)) / np.log(agree)), 0, self.bits).astype(np.int64)

    def search(self, queries: np.ndarray, k: int, bound: np.ndarray | None = None, miss: float = MISS, first: int = FIRST):
        """Of every query the ``k`` best candidates (ties too): query, row, inner product. Without ``bound``
        the first round, with it (the k-th best product so far) the second."""
        norms = np.sqrt((queries * queries).sum(1))
        strings = _strings(np.concatenate((queries / np.maximum(norms, 1e-300)[:, None], np.zeros((len(queries), 1))), 1), self.trees, self.bits, self.seed)
        depth = self._first_depth(strings, first * k) if bound is None else self._last_depth(bound / (norms * self.longest), miss)
        parts = []
        for a in range(0, len(queries), GROUP):
            own = slice(a, a + GROUP)
            floor = np.full(len(queries[own]), -np.inf) if bound is None else bound[own]
            query, row, score = self._scored(queries[own], self._candidates(strings[own], depth[own]), k, floor, 1e-9 * norms[own] * self.longest)
            parts.append((query + a, row, score))
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    def _candidates(self, strings: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Flags (queries x rows) of the rows that share a prefix of the query's depth in some tree."""
        seen = np.zeros((len(strings), len(self.vectors)), bool)
        cut = self.bits - depth
        for t in range(self.trees):
            low, high = self._ranges(strings, t, cut)
            size = high - low
            query = np.repeat(np.arange(len(strings)), size)
            at = np.arange(len(query)) + (low - (np.cumsum(size) - size))[query]
            seen[query, self.order[t, at]] = True
        return seen

    def _scored(self, queries: np.ndarray, seen: np.ndarray, k: int, floor: np.ndarray, slack: np.ndarray):
        """The ``k`` best of every query's candidates at ``floor`` or above, with ties."""
        if seen.mean() >= DENSE:
            scores = np.where(seen, queries @ self.vectors.T, -np.inf)
        else:
            scores = np.full(seen.shape, -np.inf)
            for q in range(len(queries)):
                own = np.flatnonzero(seen[q])
                scores[q, own] = self.vectors[own] @ queries[q]
        if len(self.vectors) > k:
            floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
        query, row = np.nonzero((scores >= (floor - slack)[:, None]) & seen)
        exact = np.empty(len(query))
        for a in range(0, len(query), 65536):  # the same sum for a pair wherever it is
            exact[a : a + 65536] = (self.vectors[row[a : a + 65536]] * queries[query[a : a + 65536]]).sum(1)
        return query, row, exact


def _strings(points: np.ndarray, trees: int, bits: int, seed: int) -> np.ndarray:
    planes = np.random.default_rng(seed).normal(size=(points.shape[1], trees * bits))
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    out = np.empty((len(points), trees), np.int64)
    for a in range(0, len(points), 1024):
        signs = (points[a : a + 1024] @ planes > 0).reshape(-1, trees, bits)
        out[a : a + 1024] = signs @ weights
    return out


def valid_vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vec, key)`` of the rows that take part; one row per id."""
    v = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    v = v.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    return v.withColumn("key", F.md5(F.col("vec").cast("string").cast("binary")))


def nearest(
    table: DataFrame,
    k: int,
    is_query,
    id_column: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    trees: int = TREES,
    bits: int = BITS,
    miss: float = MISS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product found
    for every row that ``is_query`` (a condition on ``vec_id``) holds for, itself left out."""
    spark = table.sparkSession
    rows = materialize(spark, valid_vectors(table, id_column, vector))
    size = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    width = size["d"] if size else 0
    rows = rows.where(F.size("vec") == width)
    few = rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    classes = few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
    classes = materialize(spark, classes)
    asked = materialize(spark, rows.where(is_query).select(F.col("vec_id").alias("query_id"), "key"))
    queries = materialize(spark, asked.select("key").distinct().join(classes, "key").select("key", "vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    total, longest = classes.agg(F.count(F.lit(1)), F.max(norm)).first()
    blocks = max(1, -(-total // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))

    dealt = classes.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int"))
    index = dealt.groupBy("block").applyInArrow(_builder(width, float(longest or 0.0), trees, bits), "block int, forest binary, ids array<array<long>>")
    index = materialize(spark, index)
    forests = index.select("block", "forest", "ids", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("asked"))
    dealt = queries.withColumn("asked", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(query_blocks)).cast("int"))

    def round_(asking: DataFrame) -> DataFrame:
        met = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = forests.groupBy("block", "asked").cogroup(met.groupBy("block", "asked")).applyInArrow(_searcher(k + 1, width, miss), "key string, ids array<long>, score double")
        return found.select("key", "score", F.explode("ids").alias("vec_id"))

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)

    first = materialize(spark, best(round_(dealt.withColumn("bound", F.lit(None).cast("double")).withColumn("bounded", F.lit(False)))))
    # fewer than k + 1 rows leave a query without a bound: it then meets all rows
    kth = first.groupBy("key").agg(F.max("place").alias("n"), F.min("score").alias("kth"))
    bound = F.when(F.col("n") > k, F.col("kth"))
    second = round_(dealt.join(kth, "key", "left").select("key", "vec", "asked", bound.alias("bound"), F.lit(True).alias("bounded")))
    both = second.unionByName(first.drop("place")).groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    answers = best(both).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    answers = materialize(spark, answers, spread=True)
    own = asked.join(answers, "key").select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")
    )


def _builder(width: int, longest: float, trees: int, bits: int):
    schema = pa.schema([("block", pa.int32()), ("forest", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64())))])

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        forest = Forest.build(matrix(group.column("vec"), width), longest, trees, bits)
        return pa.Table.from_pylist([{"block": group.column("block")[0].as_py(), "forest": forest.to_bytes(), "ids": group.column("ids").to_pylist()}], schema=schema)

    return build


def _searcher(k: int, width: int, miss: float):
    schema = pa.schema([("key", pa.string()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], schema=schema)
        forest = Forest.from_bytes(left.column("forest")[0].as_py())
        ids = left.column("ids").combine_chunks().flatten()
        bound = None
        if right.column("bounded")[0].as_py():
            bound = right.column("bound").combine_chunks().fill_null(-np.inf).to_numpy(zero_copy_only=False)
        query, row, score = forest.search(matrix(right.column("vec"), width), k, bound, miss)
        return pa.table([right.column("key").take(pa.array(query)), ids.take(pa.array(row)), pa.array(score)], schema=schema)

    return run


def neighbours_report(table: DataFrame) -> DataFrame:
    """20 nearest of every row whose id is divisible by 20."""
    return nearest(table, 20, F.col("vec_id") % 20 == 0)
