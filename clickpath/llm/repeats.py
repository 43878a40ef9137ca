"""Substring dedup over words with fixed-block anchors.

Every document is cut into non-overlapping blocks of ``n // 2`` words; their
hashes are the index. Every rolling window of that length probes it. A
repeat of ``n`` words always holds a whole block of one of its copies, so only
words around hits can belong to a repeat. There the hits are extended to
all windows of ``n`` words, identified by 80 hash bits beside their bucket,
and a window that also starts earlier is removed; the union of such windows
are the maximal exact repeats.

Both steps are exchanges of fingerprints between chunks and buckets (see
``chunks``): a chunk sends each distinct window once, so hot passages are
aggregated before the shuffle, and answers are one bit per fingerprint.

Order: smaller ``doc_id`` first (null before all), then earlier start. Rows
that repeat an id count as copies, in the order of their chunks and texts.
Null and empty texts have no words; texts shorter than ``n`` words lose
nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.chunks import (
    CHUNK_BYTES,
    Chunk,
    answer_rows,
    answered,
    at_buckets,
    bits,
    bucket_slices,
    chunked,
    from_chunks,
    groups_of,
    keyed,
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
    covered,
    materialize,
    mix,
    runs,
    tasks_for,
    window_starts,
    word_hashes,
    words,
)

WINDOW = 20

_SENT = "bucket int, chunk long, size long, prints binary, multi binary, block binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("prints", pa.binary()), ("multi", pa.binary()), ("block", pa.binary())])
_ANSWER = "kind int, bucket int, chunk long, size long, flags binary"
_ANSWER_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("flags", pa.binary())])
_WINDOWS = "bucket int, chunk long, size long, low binary, high binary, doc binary"
_WINDOWS_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("low", pa.binary()), ("high", pa.binary()), ("doc", pa.binary())])
_RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string()),
])


class _Words:
    """Word hashes of a chunk and the windows over them."""

    def __init__(self, chunk: Chunk, second: bool = False):
        start, end, self.first = words(chunk.data, chunk.offsets, SPACE_WORDS)
        self.total = len(start)
        self.hashes = [PrefixHash(word_hashes(chunk.data, start, end, s), s) for s in range(1 + second)]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return window_starts(self.first, n)

    def window_hash(self, start: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
        return mix(self.hashes[seed].segments(start, start + n) ^ U64(n))


class _Anchors:
    """Distinct rolling windows of one block length in a chunk."""

    def __init__(self, ws: _Words, block: int, buckets: int):
        self.start, doc = ws.windows(block)
        self.keys, self.inverse, self.counts = np.unique(
            keyed(ws.window_hash(self.start, block), buckets), return_inverse=True, return_counts=True
        )
        self.aligned = (self.start - ws.first[doc]) % block == 0


def _send_anchors(block: int, buckets: int):
    def send(chunk: Chunk) -> Iterator[dict]:
        a = _Anchors(_Words(chunk), block, buckets)
        is_block = np.zeros(len(a.keys), bool)
        is_block[a.inverse[a.aligned]] = True
        for bucket, lo, hi in bucket_slices(a.keys):
            yield {
                "bucket": bucket, "chunk": chunk.number, "size": chunk.size, "prints": pack40(a.keys[lo:hi]),
                "multi": bits(a.counts[lo:hi] > 1), "block": bits(is_block[lo:hi]),
            }

    return send


def _match_anchors(table: pa.Table) -> Iterator[dict]:
    """Flags the fingerprints that a block holds and that occur at another place too."""
    prints = [unpack40(p) for p in table.column("prints").to_pylist()]
    lengths = [len(p) for p in prints]
    value = np.concatenate(prints)
    multi = np.concatenate([unbits(m, n) for m, n in zip(table.column("multi").to_pylist(), lengths, strict=True)])
    block = np.concatenate([unbits(m, n) for m, n in zip(table.column("block").to_pylist(), lengths, strict=True)])
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = groups_of(new)
    seen = np.bincount(group, weights=1 + multi[order])
    blocks = np.bincount(group, weights=block[order])
    hit = np.zeros(len(value), bool)
    hit[order] = ((seen >= 2) & (blocks >= 1))[group]
    yield from answer_rows(table, lengths, hit, 1)


class _Candidates:
    """Distinct ``n``-word windows of a chunk that hold a hit anchor."""

    def __init__(self, ws: _Words, answers: pa.Table, n: int, buckets: int):
        block = n // 2
        anchors = _Anchors(ws, block, buckets)
        hit = np.zeros(ws.total + 1, np.int64)
        hit[anchors.start] = answered(anchors.keys, answers, 1)[anchors.inverse]
        before = np.concatenate(([0], np.cumsum(hit)))
        start, _ = ws.windows(n)
        start = start[before[start + n - block + 1] > before[start]]
        low = keyed(ws.window_hash(start, n, 0), buckets)
        high = ws.window_hash(start, n, 1) >> U64(24)
        order = np.lexsort((start, high, low))
        new = np.ones(len(order), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
        self.start, self.group = start[order], groups_of(new)
        self.first = np.flatnonzero(new)  # documents are sorted by id: the earliest start comes first
        self.low, self.high = low[order][self.first], high[order][self.first]


def _send_windows(n: int, buckets: int):
    def send(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        if answers.num_rows == 0:
            return
        ws = _Words(chunk, second=True)
        c = _Candidates(ws, answers, n, buckets)
        doc = chunk.keys[np.searchsorted(ws.first, c.start[c.first], "right") - 1]
        for bucket, lo, hi in bucket_slices(c.low):
            yield {
                "bucket": bucket, "chunk": chunk.number, "size": chunk.size,
                "low": pack40(c.low[lo:hi]), "high": pack40(c.high[lo:hi]), "doc": pack_ids(doc[lo:hi]),
            }

    return send


def _first_windows(table: pa.Table) -> Iterator[dict]:
    """Flags the windows whose earliest occurrence is in the asking chunk's first place."""
    low = [unpack40(p) for p in table.column("low").to_pylist()]
    lengths = [len(p) for p in low]
    chunk = np.repeat(np.array(table.column("chunk").to_pylist(), np.int64), lengths)
    high = np.concatenate([unpack40(p) for p in table.column("high").to_pylist()])
    doc = np.concatenate([unpack_ids(p) for p in table.column("doc").to_pylist()])
    low = np.concatenate(low)
    order = np.lexsort((chunk, doc, high, low))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    flags = np.zeros(len(low), bool)
    flags[order[new]] = True
    yield from answer_rows(table, lengths, flags, 2)


def _cut_repeats(n: int, buckets: int):
    def cut(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        if answers.num_rows:
            ws = _Words(chunk, second=True)
            c = _Candidates(ws, answers, n, buckets)
            stays = np.zeros(len(c.start), bool)
            stays[c.first] = answered(c.low, answers, 2)
            gone, first = covered(c.start[~stays], n, ws.total), ws.first
        else:
            gone, first = np.zeros(0, bool), None
        for i, doc_id in enumerate(chunk.ids.to_pylist()):
            own = chunk.document(i).split()
            lost = gone[first[i] : first[i + 1]] if first is not None else gone
            if lost.any():
                a, b = runs(lost)
                spans = [{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)]
                kept = b" ".join(compress(own, (~lost).tolist()))
            else:
                spans, kept = [], b" ".join(own)
            yield {"doc_id": doc_id, "n_words": len(own), "n_removed": int(lost.sum()), "spans": spans, "kept": kept.decode()}

    return cut


def remove_repeats(docs: DataFrame, n: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (word
    positions of the removed maximal repeats) and ``kept`` (remaining words
    joined by one space). ``docs`` must be re-readable (see ``chunks``)."""
    if n < 2:
        raise ValueError("a window has at least two words")
    spark = docs.sparkSession
    buckets = tasks_for(spark)
    docs = prepare(docs)
    sent = from_chunks(docs, _send_anchors(n // 2, buckets), _SENT, _SENT_ARROW, chunk_bytes)
    hits = materialize(spark, at_buckets(sent, buckets, _match_anchors, _ANSWER, _ANSWER_ARROW))
    parts = chunked(docs, chunk_bytes)
    windows = with_answers(parts, hits, _send_windows(n, buckets), _WINDOWS, _WINDOWS_ARROW)
    first = at_buckets(windows, buckets, _first_windows, _ANSWER, _ANSWER_ARROW)
    return with_answers(parts, hits.unionByName(first), _cut_repeats(n, buckets), _RESULT, _RESULT_ARROW)


def repeats_report(docs: DataFrame) -> DataFrame:
    """Digest of :func:`remove_repeats` per document."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
