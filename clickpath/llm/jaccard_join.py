"""N-gram Jaccard join by blocked sparse matrix products.

The document by n-gram incidence matrix is never multiplied as a whole.

1. Documents with equal sets are one class, represented by the smallest id;
   only its text goes on, so copies cost neither signatures nor room on disk.
   A set that links with another one shares all but ``1 - t`` of its n-grams,
   so sets with more n-grams that no other set holds are out: half of the
   n-grams (by hash) go through an exchange of fingerprints, which tells the
   shared ones. A passage in many documents so makes no candidates of them.
2. Blocks: two sets of at most ``r`` n-grams that reach the threshold differ in
   at most ``k = 2 r (1 - t) / (1 + t)`` n-grams, so if the n-grams are dealt
   into parts by hash and a set fills more than ``k`` parts, one filled part is
   equal in both. Each part's hash, with its size class, is a signature; a
   set that fills too few parts is dealt again with another seed. Documents
   that share a signature are joined into candidate blocks.
3. Inside a block the sparse product accumulates overlap counts over n-gram
   columns, and pairs below the bound ``overlap >= t (|x| + |y|) / (1 + t)``
   are discarded. Rows go from the most central on; a row is skipped when all
   that it could link with is in its component already, so a large group
   of near copies takes a few rows and not all pairs.
4. Blocks beyond ``block_grams`` n-grams are split: each part is multiplied with
   itself, then with the most central rows of all parts, then with the rows
   that are still apart from the largest component. These rows come in slices
   of about ``block_grams`` n-grams, so no task holds a whole hot group.
   Components are found anew before each step and a task links different ones
   only, so it emits fewer links than it has components and none between
   different components is lost.

Finished steps leave the disks at once (``common.release_files``), and the texts
that go on are a Parquet table, which is deleted at the end.

Documents link when ``100 * overlap >= percent * union`` on exact integers.

Defined results: null and empty texts have the empty set and link with nothing;
texts of fewer than ``n`` words have their whole word sequence as the only
n-gram; rows that repeat an id are one document, whose rows count as linked;
a null id takes no part and has a null component; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.chunks import (
    CHUNK_BYTES,
    Chunk,
    answered,
    at_buckets,
    bits,
    bucket_slices,
    chunked,
    from_chunks,
    keyed,
    match_twice,
    pack40,
    pack_ids,
    prepare,
    unbits,
    unpack40,
    unpack_ids,
    with_answers,
)
from clickpath.llm.common import (
    SPACE_WORDS,
    U64,
    PrefixHash,
    materialize,
    mix,
    release_files,
    released_cogroup,
    released_group,
    remove_table,
    tasks_for,
    text_bytes,
    window_starts,
    word_hashes,
    words,
    write_table,
)
from clickpath.llm.components import components

NGRAM = 4
PERCENT = 85
#: n-grams of one product; larger candidate blocks are split
BLOCK_GRAMS = 4_000_000
_SEEDS = 8

_SENT = "bucket int, chunk long, size long, prints binary, multi binary, keys binary, ids binary"
_SENT_ARROW = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("prints", pa.binary()), ("multi", pa.binary()), ("keys", pa.binary()), ("ids", pa.binary())]
)
_ANSWER = "kind int, bucket int, chunk long, size long, flags binary, firsts binary"
_ANSWER_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("flags", pa.binary()), ("firsts", pa.binary())]
)
_SETS = "doc_id long, n_shingles long, key binary, text string"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("text", pa.string())])
_SIGNED = "bucket int, prints binary, docs binary"
_SIGNED_ARROW = pa.schema([("bucket", pa.int32()), ("prints", pa.binary()), ("docs", pa.binary())])
_STARS = "bucket int, docs binary, centres binary"
_STARS_ARROW = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("centres", pa.binary())])
_EDGES = "a long, b long"
_EDGES_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every document; A-Z count as a-z."""
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    start, end, first = words(data, offsets, SPACE_WORDS)
    prefix = PrefixHash(word_hashes(data, start, end))
    at, doc = window_starts(first, n)
    grams = mix(prefix.segments(at, at + n) ^ U64(n))
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    out = []
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= n:
            out.append(np.unique(grams[cuts[i] : cuts[i + 1]]))
        elif b > a:
            whole = mix(prefix.segments(np.array([a]), np.array([b])) ^ U64(b - a))
            out.append(whole)
        else:
            out.append(np.zeros(0, U64))
    return out


# ---------------------------------------------------------------- signatures

class SizeClasses:
    """Size intervals such that linked sets are in the same or neighbouring ones."""

    def __init__(self, percent: int):
        self.percent = percent
        self.last = [0]  # largest size of each interval

    def _grow(self, size: int) -> None:
        while self.last[-1] < size:
            first = self.last[-1] + 1
            self.last.append(first * 100 // self.percent)

    def parts(self, size: int) -> list[tuple[int, int]]:
        """(interval, largest difference) of the pairs a set of this size takes part in:
        with sets of its own and the smaller interval, and with the larger one."""
        self._grow(size)
        i = int(np.searchsorted(self.last, size))
        self._grow(self.last[i] + 1)
        t = self.percent
        return [(j, 2 * self.last[j] * (100 - t) // (100 + t)) for j in (i, i + 1)]


def signatures(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """Hashes of the filled parts of one set, for both its size classes."""
    out = []
    for interval, differ in classes.parts(len(grams)):
        parts = 1 if differ == 0 else (differ + 1) * 21 // 20 + 2
        for seed in range(_SEEDS):
            mixed = mix(grams ^ U64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            part = ((mixed >> U64(32)) * U64(parts)) >> U64(32)
            order = np.argsort(part, kind="stable")  # grams are sorted: so are they inside a part
            filled, at = np.unique(part[order], return_index=True)
            sums = np.add.reduceat(mix(mixed[order] * U64(3) + U64(1)), at)
            head = U64((interval * 64 + seed) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(sums ^ mix(filled + head)))
            if len(filled) > differ:
                break
        else:
            # too few n-grams for any deal: every n-gram is a signature of its own
            head = U64((interval * 64 + 63) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(grams ^ head))
    return np.concatenate(out)


class _Profile:
    """Sets of a chunk, the keys of half of the n-grams of its distinct sets, and the
    digests of these sets with their smallest ids, by bucket."""

    def __init__(self, chunk: Chunk, n: int, buckets: int):
        self.sets = ngram_sets(chunk.data, chunk.offsets, n)
        self.keys = [_key(grams) for grams in self.sets]
        ids = chunk.ids.to_pylist()
        seen: set[bytes] = set()
        self.distinct = []
        for i, key in enumerate(self.keys):
            if key is not None and ids[i] is not None and key not in seen:
                seen.add(key)
                self.distinct.append(i)
        halves = [s[s & U64(1) == 0] for s in (self.sets[i] for i in self.distinct)]
        self.sizes = [len(h) for h in halves]
        half = keyed(mix(np.concatenate(halves)), buckets) if halves else np.zeros(0, U64)
        self.grams, self.inverse, self.counts = np.unique(half, return_inverse=True, return_counts=True)
        digests = np.frombuffer(b"".join(self.keys[i] for i in self.distinct), "<u8").reshape(-1, 2)
        own = keyed(digests[:, 0], buckets)
        self.order = np.argsort(own, kind="stable")  # of ``distinct``
        self.own, self.digests, self.ids = own[self.order], digests[self.order], chunk.keys[self.distinct][self.order]


def _send_grams(n: int, buckets: int):
    def send(chunk: Chunk) -> Iterator[dict]:
        p = _Profile(chunk, n, buckets)
        grams = {bucket: (lo, hi) for bucket, lo, hi in bucket_slices(p.grams)}
        sets = {bucket: (lo, hi) for bucket, lo, hi in bucket_slices(p.own)}
        for bucket in sorted(grams.keys() | sets.keys()):
            lo, hi = grams.get(bucket, (0, 0))
            first, last = sets.get(bucket, (0, 0))
            yield {
                "bucket": bucket,
                "chunk": chunk.number,
                "size": chunk.size,
                "prints": pack40(p.grams[lo:hi]),
                "multi": bits(p.counts[lo:hi] > 1),
                "keys": p.digests[first:last].tobytes(),
                "ids": p.ids[first:last].tobytes(),
            }

    return send


def _compare(table: pa.Table) -> Iterator[dict]:
    """Flags the n-grams that occur twice or more, and of every set the one row that represents it."""
    flags = {(r["bucket"], r["chunk"]): r["flags"] for r in match_twice(table)}
    chunks = table.column("chunk").to_pylist()
    ids = [np.frombuffer(i, np.int64) for i in table.column("ids").to_pylist()]
    lengths = [len(i) for i in ids]
    key = np.concatenate([np.frombuffer(k, "<u8").reshape(-1, 2) for k in table.column("keys").to_pylist()])
    order = np.lexsort((np.repeat(chunks, lengths), np.concatenate(ids), key[:, 1], key[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]).any(axis=1)
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    at = 0
    for bucket, chunk, size, n in zip(table.column("bucket").to_pylist(), chunks, table.column("size").to_pylist(), lengths, strict=True):
        own, shared = first[at : at + n], flags.get((bucket, chunk))
        at += n
        if shared is not None or own.any():
            kind = 2 if shared is None else 1
            yield {"kind": kind, "bucket": bucket, "chunk": chunk, "size": size, "flags": shared or b"", "firsts": bits(own)}


def _represented(p: _Profile, answers: pa.Table) -> np.ndarray:
    """Flags of the distinct sets of a chunk that represent their class."""
    got = dict(zip(answers.column("bucket").to_pylist(), answers.column("firsts").to_pylist(), strict=True))
    flags = np.zeros(len(p.distinct), bool)
    for bucket, lo, hi in bucket_slices(p.own):
        if bucket in got:
            flags[p.order[lo:hi]] = unbits(got[bucket], hi - lo)
    return flags


def _describe(n: int, percent: int, buckets: int):
    """Every document's set size and key; the text stays only with representatives that a link is possible for."""

    def describe(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        p = _Profile(chunk, n, buckets)
        shared = answered(p.grams, answers, 1)[p.inverse]
        lonely = np.add.reduceat(np.append(~shared, False).astype(np.int64), np.cumsum([0, *p.sizes[:-1]])) if p.sizes else []
        possible = {
            i
            for i, first, few, size in zip(p.distinct, _represented(p, answers), lonely, p.sizes, strict=True)
            if first and (not size or 100 * int(few) <= (100 - percent) * len(p.sets[i]))
        }
        for i, doc_id in enumerate(chunk.ids.to_pylist()):
            text = chunk.document(i).decode() if i in possible else None
            yield {"doc_id": doc_id, "n_shingles": len(p.sets[i]), "key": p.keys[i], "text": text}

    return describe


def _key(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _send_signatures(n: int, percent: int, buckets: int):
    def send(chunk: Chunk) -> Iterator[dict]:
        classes, seen, signed, owner = SizeClasses(percent), set(), [], []
        for doc_id, grams in zip(chunk.ids.to_pylist(), ngram_sets(chunk.data, chunk.offsets, n), strict=True):
            key = _key(grams)
            if key is None or doc_id is None or key in seen:
                continue
            seen.add(key)
            own = signatures(grams, classes)
            signed.append(own)
            owner.append(np.full(len(own), doc_id, np.int64))
        if not signed:
            return
        keys, docs = keyed(np.concatenate(signed), buckets), np.concatenate(owner)
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        for bucket, lo, hi in bucket_slices(keys):
            yield {"bucket": bucket, "prints": pack40(keys[lo:hi]), "docs": pack_ids(docs[lo:hi])}

    return send


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges (a, b) that is not the smallest of its component, and that smallest node."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        for side in (x, y):
            np.minimum.at(label, label[side], least)
            np.minimum.at(label, side, least)
        label = label[label]
        if np.array_equal(label, before):
            break
    others = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[others], nodes[label[others]]


def _stars(buckets: int):
    def stars(table: pa.Table) -> Iterator[dict]:
        """Spanning stars of the documents that share signatures in a bucket, sent on by their centre."""
        prints = np.concatenate([unpack40(p) for p in table.column("prints").to_pylist()])
        docs = np.concatenate([unpack_ids(d) for d in table.column("docs").to_pylist()])
        order = np.lexsort((docs, prints))
        prints, docs = prints[order], docs[order]
        new = np.ones(len(prints), bool)
        new[1:] = prints[1:] != prints[:-1]
        centre = docs[np.flatnonzero(new)][np.cumsum(new) - 1]
        other, centre = spanning_stars(docs[docs != centre], centre[docs != centre])
        to = (mix(centre.astype(U64)) % U64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.flatnonzero(np.diff(to[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            yield {"bucket": int(to[part[0]]), "docs": pack_ids(other[part]), "centres": pack_ids(centre[part])}

    return stars


def _merged_stars(table: pa.Table) -> Iterator[dict]:
    """The stars that all buckets found around the same centres, each edge once."""
    docs = np.concatenate([unpack_ids(d) for d in table.column("docs").to_pylist()])
    centres = np.concatenate([unpack_ids(d) for d in table.column("centres").to_pylist()])
    for a, b in zip(*(x.tolist() for x in spanning_stars(docs, centres)), strict=True):
        yield {"a": a, "b": b}


# ---------------------------------------------------------------- products

class Block:
    """Rows of the incidence matrix and, per n-gram column, the rows that hold it."""

    def __init__(self, nodes: np.ndarray, sets: list[np.ndarray]):
        self.nodes, self.sets = nodes, sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        grams = np.concatenate(sets) if sets else np.zeros(0, U64)
        rows = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(grams, kind="stable")
        self.columns, first = np.unique(grams[order], return_index=True)
        self.rows = rows[order]
        self.starts = np.append(first, len(grams))

    def overlaps(self, grams: np.ndarray) -> np.ndarray:
        """Overlap of one row with every row of the block, by accumulation over columns."""
        at = np.searchsorted(self.columns, grams)
        at = at[at < len(self.columns)] if len(self.columns) == 0 else np.minimum(at, len(self.columns) - 1)
        at = at[self.columns[at] == grams] if len(at) == len(grams) else at
        counts = self.starts[at + 1] - self.starts[at]
        skip = np.cumsum(counts) - counts
        where = np.arange(int(counts.sum())) - np.repeat(skip, counts) + np.repeat(self.starts[at], counts)
        return np.bincount(self.rows[where], minlength=len(self.sets))

    def degrees(self) -> np.ndarray:
        """Sum of the column sizes of every row: how central it is."""
        counts = np.diff(self.starts)
        return np.bincount(self.rows, weights=np.repeat(counts, counts), minlength=len(self.sets))


def _linked(sizes: np.ndarray, size: int, overlap: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (sizes + size - overlap)


def _in_range(sizes: np.ndarray, size: int, percent: int) -> np.ndarray:
    return (100 * sizes >= percent * size) & (percent * sizes <= 100 * size)


def product_links(block: Block, percent: int, labels: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the links inside a block, and the component labels."""
    labels = np.arange(len(block.sets)) if labels is None else labels
    links = []
    for i in np.argsort(-block.degrees(), kind="stable").tolist():
        size = int(block.sizes[i])
        apart = (labels != labels[i]) & _in_range(block.sizes, size, percent)
        if not apart.any():
            continue
        hit = np.flatnonzero(apart & _linked(block.sizes, size, block.overlaps(block.sets[i]), percent))
        for j in hit.tolist():
            if labels[j] != labels[i]:
                links.append((int(block.nodes[i]), int(block.nodes[j])))
                labels[labels == labels[j]] = labels[i]
    return links, labels


def cross_links(
    block: Block, labels: np.ndarray, nodes: list[int], sets: list[np.ndarray], their_labels: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links of other rows with the rows of a block that join different components."""
    links = []
    labels, theirs = labels.copy(), their_labels.copy()
    for k, (node, grams) in enumerate(zip(nodes, sets, strict=True)):
        size = len(grams)
        apart = _in_range(block.sizes, size, percent) & (labels != theirs[k])
        if apart.any():
            hit = np.flatnonzero(apart & _linked(block.sizes, size, block.overlaps(grams), percent))
            for j in hit.tolist():
                if (joined := labels[j]) != theirs[k]:
                    links.append((node, int(block.nodes[j])))
                    labels[labels == joined] = theirs[k]
                    theirs[theirs == joined] = theirs[k]
    return links


def _table_sets(table: pa.Table, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    data, offsets = text_bytes(table.column("text"))
    return table.column("node").to_numpy(), ngram_sets(data, offsets, n)


def _own_products(n: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes, sets = _table_sets(table, n)
        block_of = table.column("block").to_numpy()
        links = []
        for rows in _groups(block_of):
            if len(rows) > 1:
                links += product_links(Block(nodes[rows], [sets[i] for i in rows]), percent)[0]
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in links], schema=_EDGES_ARROW)

    return run


def _groups(values: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order])) + 1) if len(order) else []


def _central_rows(n: int, keep: int):
    def run(table: pa.Table) -> pa.Table:
        nodes, sets = _table_sets(table, n)
        top = np.argsort(-Block(nodes, sets).degrees(), kind="stable")[:keep]
        return table.take(pa.array(np.sort(top)))

    return run


def _cross_products(n: int, percent: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.Table.from_pylist([], schema=_EDGES_ARROW)
        nodes, sets = _table_sets(left, n)
        others, their_sets = _table_sets(right, n)
        labels, their_labels = (t.column("component").to_numpy() for t in (left, right))
        links = cross_links(Block(nodes, sets), labels, others.tolist(), their_sets, their_labels, percent)
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in links], schema=_EDGES_ARROW)

    return run


_SPLIT = "block long, part int, parts int, node long, grams long, component long, text string"


def _split_links(rows: DataFrame, own: DataFrame, n: int, percent: int, block_grams: int, central: int = 8) -> DataFrame:
    """Links of the split blocks (``block``, ``part``, ``parts``, ``node``, ``grams``, ``text``), with
    those inside their parts (``own``)."""
    spark = rows.sparkSession
    columns = ("block", "part", "slice", "node", "component", "text")
    key = ("block", "part", "slice")

    def labelled(links: DataFrame) -> DataFrame:
        found = rows.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        return materialize(spark, found.select("block", "part", "parts", "node", "grams", "component", "text"))

    def cross(parts: DataFrame, asked: DataFrame) -> DataFrame:
        """Links of ``asked`` rows, a slice of them at a time, with all parts of their block."""
        # a block beyond block_grams is one row here
        slices = asked.groupBy("block").agg(F.ceil(F.sum("grams") / F.lit(block_grams)).cast("int").alias("slices"))
        slices = F.broadcast(materialize(spark, slices))
        left = parts.join(slices, "block").withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
        right = asked.drop("part").join(slices, "block").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(1)), F.col("slices")).cast("int"))
        right = right.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        left, right = (df.select(*[F.col(c).alias(c) for c in columns]) for df in (left, right))  # own column identities
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(released_cogroup(_cross_products(n, percent)), _EDGES)

    linked = materialize(spark, own)
    parts = labelled(linked)
    hubs = materialize(spark, parts.groupBy("block", "part").applyInArrow(released_group(_central_rows(n, central)), _SPLIT))
    linked = materialize(spark, linked.unionByName(cross(parts, hubs)))
    # rows outside the largest component of their block meet all parts
    parts = labelled(linked)
    sizes = parts.groupBy("block", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = materialize(spark, sizes.groupBy("block").agg(F.max_by("component", F.struct("size", "component")).alias("largest")))
    apart = parts.join(F.broadcast(largest), "block").where("component <> largest").drop("largest")
    return linked.unionByName(cross(parts, apart))


def near_duplicates(
    docs: DataFrame,
    n: int = NGRAM,
    percent: int = PERCENT,
    block_grams: int = BLOCK_GRAMS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest
    id reachable by links. ``docs`` must be re-readable (see ``chunks``)."""
    spark = docs.sparkSession
    buckets = tasks_for(spark)
    docs = prepare(docs)
    sent = from_chunks(docs, _send_grams(n, buckets), _SENT, _SENT_ARROW, chunk_bytes)
    shared = materialize(spark, at_buckets(sent, buckets, _compare, _ANSWER, _ANSWER_ARROW))
    release_files(spark)
    described, path = write_table(spark, with_answers(chunked(docs, chunk_bytes), shared, _describe(n, percent, buckets), _SETS, _SETS_ARROW), "sets")
    del shared
    release_files(spark)
    try:
        sets = materialize(spark, described.drop("text"))
        label = _labels(sets, described.where("text is not null").select("doc_id", "n_shingles", "text"), n, percent, block_grams, chunk_bytes)
    finally:
        remove_table(spark, path)
    release_files(spark)
    return sets.select("doc_id", "n_shingles").join(label, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _labels(sets: DataFrame, possible: DataFrame, n: int, percent: int, block_grams: int, chunk_bytes: int) -> DataFrame:
    """``component_id`` of every ``doc_id`` that has n-grams."""
    spark = sets.sparkSession
    buckets = tasks_for(spark)
    known = sets.where("key is not null and doc_id is not null")
    first = materialize(spark, known.groupBy("key").agg(F.min("doc_id").alias("node")), spread=True)
    member = materialize(spark, known.join(first, "key").select("doc_id", "n_shingles", "node"))

    # the texts are those of representatives, so the ends of the stars are nodes
    signed = from_chunks(possible.select("doc_id", "text"), _send_signatures(n, percent, buckets), _SIGNED, _SIGNED_ARROW, chunk_bytes)
    stars = at_buckets(signed, buckets, _stars(buckets), _STARS, _STARS_ARROW)
    blocks = materialize(spark, components(at_buckets(stars, buckets, _merged_stars, _EDGES, _EDGES_ARROW)))
    release_files(spark)

    # texts of the representatives in candidate blocks, next to each other
    weight = possible.groupBy(F.col("doc_id").alias("node")).agg(F.max("n_shingles").alias("grams"))
    blocks = blocks.withColumnRenamed("component", "block").join(weight, "node")
    grams = blocks.groupBy("block").agg(F.sum("grams").alias("total"))
    grams = materialize(spark, grams)
    placed = blocks.join(grams, "block").withColumn("parts", F.ceil(F.col("total") / F.lit(block_grams)).cast("int"))
    placed = materialize(spark, placed.select("node", "block", "parts", "grams"))
    rows = possible.select(F.col("doc_id").alias("node"), "text").join(placed, "node")
    whole = rows.where("parts = 1").withColumn("task", F.pmod(F.xxhash64("block"), F.lit(4 * buckets)))
    links = whole.groupBy("task").applyInArrow(released_group(_own_products(n, percent)), _EDGES)
    if placed.where("parts > 1").limit(1).count():
        split = rows.where("parts > 1").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        split = materialize(spark, split)
        own = split.groupBy("block", "part").applyInArrow(released_group(_own_products(n, percent)), _EDGES)
        links = links.unionByName(_split_links(split, own, n, percent, block_grams))
    # rows that repeat an id are one document
    to_node = member.select("doc_id", "node").distinct()
    least = to_node.groupBy("doc_id").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = to_node.join(least, "doc_id").select(F.col("node").alias("a"), "b")
    found = materialize(spark, components(links.unionByName(same)))
    release_files(spark)
    classes = to_node.groupBy("doc_id").agg(F.min("node").alias("node"))
    label = classes.join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    return materialize(spark, label)
