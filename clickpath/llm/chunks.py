"""Documents in chunks, and exchanges of their fingerprints.

Operators that look for equal passages work on chunks of documents (a few MB
each, cut between documents). A chunk sends each distinct fingerprint once,
however often it occurs in it, to the bucket that the fingerprint's hash
names; the bucket compares what all chunks sent and answers each chunk with
one bit (or a few bytes) per fingerprint. So a passage shared by a third of
all documents costs its bucket one entry per chunk, not one per document.

A chunk is named by its scan task and its place in it. ``docs`` must
therefore be re-readable: a file scan with narrow steps on it (pass
``common.materialize(...)`` of anything else). Answers carry the chunk's size,
and a chunk that differs when it is read again is an error, never a wrong
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import U64, byte_chunks, keep_rows, released, released_cogroup, text_bytes

#: bytes of text in a chunk (or one longer document)
CHUNK_BYTES = 4 << 20

FINGERPRINT_BITS = 40
_LOW = U64((1 << FINGERPRINT_BITS) - 1)


class Chunk:
    """Documents of one chunk, sorted by id (null first): ids, bytes, offsets."""

    def __init__(self, number: int, ids: pa.Array, text: pa.Array):
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        key = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).copy()
        key[null] = np.iinfo(np.int64).min
        # texts break ties, so rows with the same id are in the same order whenever they are read
        if len(np.unique(key)) < len(key):
            texts = text.to_pylist()
            order = np.array(sorted(range(len(key)), key=lambda i: (key[i], texts[i] is not None, texts[i] or "")), np.int64)
        else:
            order = np.argsort(key, kind="stable")
        self.number = number
        self.ids = ids.take(pa.array(order))
        self.keys = key[order]
        self.data, self.offsets = text_bytes(text.take(pa.array(order)))

    @property
    def size(self) -> int:
        return len(self.data) * 4096 + len(self.keys) % 4096

    def document(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def prepare(docs: DataFrame) -> DataFrame:
    return keep_rows(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _cut(batches, chunk_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column("text"))
        for lo, hi in byte_chunks(offsets, chunk_bytes):
            yield (part << 32) + seq, batch.slice(lo, hi - lo)
            seq += 1


def from_chunks(docs: DataFrame, fn: Callable[[Chunk], Iterator[dict]], schema: str, arrow: pa.Schema, chunk_bytes: int) -> DataFrame:
    """Rows that ``fn`` makes of every chunk; one narrow pass over ``docs``."""

    def run(batches):
        for number, batch in _cut(batches, chunk_bytes):
            rows = list(fn(Chunk(number, batch.column("doc_id"), batch.column("text"))))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.mapInArrow(released(run), schema)


def chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``docs`` with the number of their chunk."""

    def run(batches):
        for number, batch in _cut(batches, chunk_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, number), pa.int64()), batch.column("doc_id"), batch.column("text")],
                ["chunk", "doc_id", "text"],
            )

    return docs.mapInArrow(released(run), "chunk long, doc_id long, text string")


def at_buckets(rows: DataFrame, buckets: int, fn: Callable[[pa.Table], Iterator[dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Answers that ``fn`` makes of all rows of a bucket; one task per bucket.

    Buckets hold equal shares of the hash range, so their number (the
    session's shuffle partitions) bounds the memory of a task.
    """

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            out: list[dict] = []
            held = 0
            for row in fn(pa.Table.from_batches(batches)):
                out.append(row)
                held += sum(len(v) for v in row.values() if isinstance(v, bytes))
                if held > 16 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.repartitionById(buckets, "bucket").mapInArrow(released(run), schema)


def with_answers(parts: DataFrame, answers: DataFrame, fn: Callable[[Chunk, pa.Table], Iterator[dict]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows that ``fn`` makes of every chunk of ``chunked`` documents and its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            raise RuntimeError("answers for a chunk that is not there: the documents changed between two reads")
        chunk = Chunk(left.column("chunk")[0].as_py(), left.column("doc_id"), left.column("text"))
        if any(s != chunk.size for s in right.column("size").to_pylist()):
            raise RuntimeError("a chunk differs from the one that asked: the documents changed between two reads")
        return pa.Table.from_pylist(list(fn(chunk, right)), schema=arrow)

    return parts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(released_cogroup(run), schema)


# ---------------------------------------------------------------- fingerprints

def keyed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 40 | low 40 bits: sorts by bucket, then by fingerprint."""
    bucket = ((hashes >> U64(FINGERPRINT_BITS)) * U64(buckets)) >> U64(64 - FINGERPRINT_BITS)
    return (bucket << U64(FINGERPRINT_BITS)) | (hashes & _LOW)


def bucket_slices(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys."""
    bucket = (keys >> U64(FINGERPRINT_BITS)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    lows = np.concatenate(([0], cuts)) if len(keys) else []
    for lo, hi in zip(lows, [*cuts, len(keys)], strict=False):
        yield int(bucket[lo]), int(lo), int(hi)


def pack40(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack40(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def groups_of(sorted_flags_new: np.ndarray) -> np.ndarray:
    """Group number of each entry, from flags that mark the first of a group."""
    return np.cumsum(sorted_flags_new) - 1


# ---------------------------------------------------------------- asking and answering

def answer_rows(table: pa.Table, lengths: list[int], flags: np.ndarray, kind: int) -> Iterator[dict]:
    """One answer per sent row that has a set flag."""
    at = 0
    for bucket, chunk, size, n in zip(
        table.column("bucket").to_pylist(), table.column("chunk").to_pylist(), table.column("size").to_pylist(), lengths, strict=True
    ):
        own = flags[at : at + n]
        at += n
        if own.any():
            yield {"kind": kind, "bucket": bucket, "chunk": chunk, "size": size, "flags": bits(own)}


def match_twice(table: pa.Table) -> Iterator[dict]:
    """Flags the fingerprints (``prints``, ``multi``) that occur twice or more."""
    prints = [unpack40(p) for p in table.column("prints").to_pylist()]
    lengths = [len(p) for p in prints]
    value = np.concatenate(prints)
    multi = np.concatenate([unbits(m, k) for m, k in zip(table.column("multi").to_pylist(), lengths, strict=True)])
    order = np.argsort(value, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = value[order][1:] != value[order][:-1]
    group = groups_of(new)
    hit = np.zeros(len(value), bool)
    hit[order] = (np.bincount(group, weights=1 + multi[order]) >= 2)[group]
    yield from answer_rows(table, lengths, hit, 1)


def answered(keys: np.ndarray, answers: pa.Table, kind: int) -> np.ndarray:
    """Flags of sorted distinct keys, from the answers of one kind."""
    got = {
        b: f
        for k, b, f in zip(answers.column("kind").to_pylist(), answers.column("bucket").to_pylist(), answers.column("flags").to_pylist(), strict=True)
        if k == kind
    }
    flags = np.zeros(len(keys), bool)
    for bucket, lo, hi in bucket_slices(keys):
        if bucket in got:
            flags[lo:hi] = unbits(got[bucket], hi - lo)
    return flags


def pack_ids(ids: np.ndarray) -> bytes:
    """The smallest id and the distances from it, in as few bytes as they need."""
    base = int(ids.min())
    rest = ids.astype(np.uint64) - np.uint64(base % (1 << 64))
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if int(rest.max()) < 1 << (8 * int(k[2])))
    return base.to_bytes(8, "little", signed=True) + bytes([int(kind[2])]) + rest.astype(kind).tobytes()


def unpack_ids(raw: bytes) -> np.ndarray:
    base = int.from_bytes(raw[:8], "little", signed=True)
    rest = np.frombuffer(raw, f"<u{raw[8]}", offset=9).astype(np.uint64)
    return (rest + np.uint64(base % (1 << 64))).astype(np.int64)
