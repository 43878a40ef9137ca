"""Suffix-array dedup of byte strings of ``n`` bytes (400 by default).

Sorting every suffix of a corpus would move many times its size, so suffixes
are sorted around anchors only. The anchor of a window is the position of the
smallest hash among its substrings of ``n // 3`` bytes, so equal windows have
equal anchors at equal places, and each anchor rules one run of windows.
Anchors whose substring occurs only once rule no repeats. For the others the
text of the run's windows goes to the bucket of the anchor's hash. There the
forward and the backward extensions of all anchors are sorted with the
hash-compared merge sort of ``suffixes``, and the common extensions of
neighbours tell which windows occur at two places: windows that start ``b``
bytes before their anchors are equal if the anchors share ``b`` bytes
backward and ``n - b`` bytes forward.

A chunk sends equal runs once with a flag (see ``chunks``). Runs of one anchor
whose contexts differ are different texts, so the first exchange also counts the
distinct texts of every anchor. An anchor with more than ``sort_bytes`` of them is
hot, and its texts never meet in one task: its windows are split by how far they reach
before the anchor, into cells of ``w`` consecutive starts for falling ``w`` down to
1. All windows of a cell share a core of ``n - w + 1`` bytes, the longer the
narrower the cell, so windows are equal only if their cores are. One exchange counts
the cores of all widths; a window whose core occurs once in some width is no repeat, and
the others are sorted, like the rest, with the widest core that is not hot itself. A
core of width 1 is the window, whose texts are all equal. Hashes choose buckets and
drop what is unique; equality is decided by the sort alone, which verifies it
against the bytes. Every byte covered by a repeated window is removed, whichever copy
it is in.

A chunk is at least one whole document: a task holds about 50 bytes for each byte of
the longest one, which bounds documents to about 20 MB in an executor of 3 GB.

Null and empty texts have no bytes; texts shorter than ``n`` bytes lose
nothing; repeated rows are copies of each other; an empty table gives no
rows; extra columns are ignored. What is left may be cut inside a character,
so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm import suffixes
from clickpath.llm.chunks import (
    FINGERPRINT_BITS,
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
from clickpath.llm.common import U64, PrefixHash, covered, materialize, mix, runs, tasks_for

WINDOW = 400
CHUNK_BYTES = 1 << 20
#: text of the anchor groups that are sorted together; a larger group is hot
SORT_BYTES = 1 << 20
#: buckets per shuffle partition of the session: they hold texts, not fingerprints
BUCKETS_PER_TASK = 3

#: how much narrower the cells of a hot anchor's windows get from width to width
NARROWING = 4

#: kinds of answers: anchors that occur twice, windows of their texts, hot anchors; the same for cores of hot anchors
_TWICE, _SORTED, _HOT, _CORE_TWICE, _CORE_SORTED, _CORE_HOT = 1, 2, 3, 4, 5, 6
_SENT = "bucket int, chunk long, size long, prints binary, multi binary, texts binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("prints", pa.binary()), ("multi", pa.binary()), ("texts", pa.binary())])
_ANSWER = "kind int, bucket int, chunk long, size long, flags binary"
_ANSWER_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()), ("flags", pa.binary())])
_SPANS = "kind int, bucket int, chunk long, size long, prints binary, before binary, windows binary, multi binary, texts binary"
_SPANS_ARROW = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("size", pa.int64()),
    ("prints", pa.binary()), ("before", pa.binary()), ("windows", pa.binary()), ("multi", pa.binary()), ("texts", pa.binary()),
])
_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary()),
])


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, from block-wise running minima."""
    n = len(values)
    if n < w:
        return values[:0]
    padded = np.full(-(-n // w) * w, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


class _Runs:
    """Runs of windows with the same anchor: first window, number, anchor, key, hash of the text."""

    def __init__(self, chunk: Chunk, n: int, buckets: int):
        seed = max(1, n // 3)
        total = len(chunk.data)
        self.prefix = None
        if total < n:
            self.first = self.count = self.anchor = np.zeros(0, np.int64)
            self.key = self.text = np.zeros(0, U64)
            return
        prefix = PrefixHash(chunk.data)
        where = np.arange(total - seed + 1)
        seeds = mix(prefix.segments(where, where + seed))
        ranked = (seeds & U64(0xFFFFFFFF00000000)) | where.astype(U64)
        del where
        anchor = sliding_min(ranked, n - seed + 1)
        del ranked
        anchor = (anchor & U64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(total - n + 1, bool)
        doc = np.zeros(total - n + 1, bool)  # first windows of documents
        for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True):
            if b - a >= n:
                inside[a : b - n + 1] = True
                doc[a] = True
        start = np.flatnonzero(inside)
        own = anchor[start]
        new = np.ones(len(start), bool)
        new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
        new |= doc[start]
        at = np.flatnonzero(new)
        self.first = start[at]
        self.count = np.diff(np.concatenate((at, [len(start)])))
        self.anchor = own[at]
        # anchors have the smallest hashes, which would all fall into the first buckets: hashed anew
        self.key = keyed(mix(seeds[self.anchor] + U64(0x9E3779B97F4A7C15)), buckets)
        self.prefix = prefix
        self.text = _text_hashes(prefix, self.first, self.count, self.anchor, n)


def _text_hashes(prefix: PrefixHash, first: np.ndarray, count: np.ndarray, anchor: np.ndarray, n: int) -> np.ndarray:
    place = (anchor - first).astype(U64) << U64(32) | count.astype(U64)
    return mix(prefix.segments(first, first + count + n - 1)) ^ mix(place)


def cell_widths(n: int) -> list[int]:
    """Widths of the cells, from below the widest run down to 1."""
    widths = [n - max(1, n // 3) + 1]
    while widths[-1] > 1:
        widths.append(-(-widths[-1] // NARROWING))
    return widths[1:]


class _Cells:
    """Runs cut into cells of ``width``: like ``_Runs``, with the keys of the cells' cores."""

    def __init__(self, r: _Runs, chosen: np.ndarray, width: int, n: int, buckets: int):
        most = r.anchor[chosen] - r.first[chosen]  # bytes before the anchor, falling along a run
        least = most - r.count[chosen] + 1
        cells = most // width - least // width + 1
        run = np.repeat(np.arange(len(chosen)), cells)
        cell = least[run] // width + np.arange(len(run)) - (np.cumsum(cells) - cells)[run]
        high = np.minimum(most[run], cell * width + width - 1)
        low = np.maximum(least[run], cell * width)
        self.anchor = r.anchor[chosen][run]
        self.first, self.count = self.anchor - high, high - low + 1
        if not len(run):
            self.key = self.text = np.zeros(0, U64)
            return
        start = self.anchor - cell * width
        core = mix(r.prefix.segments(start, start + n - width + 1))
        self.key = keyed(mix(core + U64(0xD1342543DE82EF95 * width % (1 << 64))), buckets)
        self.text = _text_hashes(r.prefix, self.first, self.count, self.anchor, n)


def _prints(chunk: Chunk, key: np.ndarray, text: np.ndarray) -> Iterator[dict]:
    """Each distinct key once, whether it occurs twice or more here, and its number of texts."""
    keys, counts = np.unique(key, return_counts=True)
    pairs = np.unique(np.stack((key, text)), axis=1)[0]
    texts = np.unique(pairs, return_counts=True)[1]
    for bucket, lo, hi in bucket_slices(keys):
        yield {
            "bucket": bucket, "chunk": chunk.number, "size": chunk.size, "prints": pack40(keys[lo:hi]),
            "multi": bits(counts[lo:hi] > 1), "texts": pack_ids(texts[lo:hi]),
        }


def _send_anchors(n: int, buckets: int):
    def send(chunk: Chunk) -> Iterator[dict]:
        r = _Runs(chunk, n, buckets)
        yield from _prints(chunk, r.key, r.text)

    return send


def _match_anchors(most: int, kind_twice: int = _TWICE, kind_hot: int = _HOT):
    def match(table: pa.Table) -> Iterator[dict]:
        """Flags the keys that occur twice or more, apart if they have more than ``most`` texts."""
        prints = [unpack40(p) for p in table.column("prints").to_pylist()]
        lengths = [len(p) for p in prints]
        value = np.concatenate(prints)
        multi = np.concatenate([unbits(m, k) for m, k in zip(table.column("multi").to_pylist(), lengths, strict=True)])
        texts = np.concatenate([unpack_ids(t) for t in table.column("texts").to_pylist()])
        order = np.argsort(value, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = value[order][1:] != value[order][:-1]
        group = groups_of(new)
        twice, hot = np.zeros(len(value), bool), np.zeros(len(value), bool)
        hot[order] = (np.bincount(group, weights=texts[order]) > most)[group]
        twice[order] = (np.bincount(group, weights=1 + multi[order]) >= 2)[group]
        yield from answer_rows(table, lengths, twice & ~hot, kind_twice)
        yield from answer_rows(table, lengths, twice & hot, kind_hot)

    return match


def _answered_runs(r, answers: pa.Table, kind: int) -> np.ndarray:
    keys = np.unique(r.key)
    return np.flatnonzero(answered(keys, answers, kind)[np.searchsorted(keys, r.key)])


class _Spans:
    """Distinct texts of runs (or of cells of them), in bucket order."""

    def __init__(self, chunk: Chunk, first, count, anchor, key, n: int):
        order = np.argsort(key, kind="stable")
        raw = chunk.data.tobytes() if len(order) else b""
        seen: dict[tuple[int, int, int, bytes], int] = {}
        self.runs: list[list[int]] = []  # first windows of the runs of each distinct text
        self.texts: list[tuple[int, int, bytes]] = []
        self.keys: list[int] = []
        for f, c, a, k in zip(first[order].tolist(), count[order].tolist(), anchor[order].tolist(), key[order].tolist(), strict=True):
            text = (a - f, c, raw[f : f + c + n - 1])
            at = seen.get((k, *text))
            if at is None:
                seen[(k, *text)] = len(self.texts)
                self.texts.append(text)
                self.keys.append(k)
                self.runs.append([f])
            else:
                self.runs[at].append(f)

    def slices(self) -> Iterator[tuple[int, int, int]]:
        return bucket_slices(np.array(self.keys, U64))

    def rows(self, chunk: Chunk, kind: int) -> Iterator[dict]:
        for bucket, lo, hi in self.slices():
            own = self.texts[lo:hi]
            yield {
                "kind": kind, "bucket": bucket, "chunk": chunk.number, "size": chunk.size, "prints": pack40(np.array(self.keys[lo:hi], U64)),
                "before": np.array([t[0] for t in own], "<u4").tobytes(),
                "windows": np.array([t[1] for t in own], "<u4").tobytes(),
                "multi": bits(np.array([len(r) > 1 for r in self.runs[lo:hi]])),
                "texts": b"".join(t[2] for t in own),
            }

    def repeated(self, answers: pa.Table, kind: int) -> list[np.ndarray]:
        """Starts of the windows that are flagged in the answers."""
        got = _by_bucket(answers, kind)
        starts = []
        for bucket, lo, hi in self.slices():
            if bucket not in got:
                continue
            sizes = [t[1] for t in self.texts[lo:hi]]
            flags = unbits(got[bucket], sum(sizes))
            at = 0
            for k, w in zip(range(lo, hi), sizes, strict=True):
                offsets = np.flatnonzero(flags[at : at + w])
                at += w
                if len(offsets):
                    starts += [first + offsets for first in self.runs[k]]
        return starts


def _cold_spans(chunk: Chunk, r: _Runs, answers: pa.Table, n: int) -> _Spans:
    """Runs whose anchors occur twice and are not hot."""
    own = _answered_runs(r, answers, _TWICE)
    return _Spans(chunk, r.first[own], r.count[own], r.anchor[own], r.key[own], n)


class _Cores:
    """Cells of hot anchors' runs in all widths, and all their cores as they are sent."""

    def __init__(self, r: _Runs, answers: pa.Table, n: int, buckets: int):
        self.runs, self.n, self.buckets = r, n, buckets
        self.hot = _answered_runs(r, answers, _HOT)
        self.cells = [_Cells(r, self.hot, width, n, buckets) for width in cell_widths(n)]
        self.key, self.text = (np.concatenate([getattr(c, name) for c in self.cells]) for name in ("key", "text"))

    def spans(self, chunk: Chunk, answers: pa.Table) -> _Spans:
        """Each window in the widest cell whose core is not hot, without those whose core occurs once
        in this width or a wider one."""
        keys = np.unique(self.key)
        twice, hot = (answered(keys, answers, kind) for kind in (_CORE_TWICE, _CORE_HOT))
        found = [np.zeros((4, 0), np.int64)]
        runs, rest = self.runs, self.hot
        for width in cell_widths(self.n):
            c = _Cells(runs, rest, width, self.n, self.buckets)
            at = np.searchsorted(keys, c.key)
            rest = np.flatnonzero(hot[at]) if width > 1 else np.zeros(0, np.int64)
            # texts of a core of width 1 are all equal: as many as there are, they are one class
            take = np.flatnonzero(twice[at] if width > 1 else twice[at] | hot[at])
            found.append(np.stack((c.first[take], c.count[take], c.anchor[take], c.key[take].astype(np.int64))))
            runs = _Part(c, runs.prefix)
        first, count, anchor, key = np.concatenate(found, axis=1)
        return _Spans(chunk, first, count, anchor, key.astype(U64), self.n)


class _Part:
    """Cells as the runs that the next narrower cells are cut from."""

    def __init__(self, cells: _Cells, prefix: PrefixHash):
        self.first, self.count, self.anchor, self.prefix = cells.first, cells.count, cells.anchor, prefix


def _by_bucket(answers: pa.Table, kind: int) -> dict[int, bytes]:
    columns = [answers.column(c).to_pylist() for c in ("kind", "bucket", "flags")]
    return {b: f for k, b, f in zip(*columns, strict=True) if k == kind}


def _send_spans(n: int, buckets: int):
    def send(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        if answers.num_rows == 0:
            return
        r = _Runs(chunk, n, buckets)
        yield from _cold_spans(chunk, r, answers, n).rows(chunk, _SORTED)
        cores = _Cores(r, answers, n, buckets)
        for row in _prints(chunk, cores.key, cores.text) if len(cores.key) else ():
            yield row | {"kind": _CORE_TWICE}

    return send


def _send_hot_spans(n: int, buckets: int):
    def send(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        if _HOT in answers.column("kind").to_pylist():
            yield from _Cores(_Runs(chunk, n, buckets), answers, n, buckets).spans(chunk, answers).rows(chunk, _CORE_SORTED)

    return send


def _sort_spans(n: int, most: int):
    cores = _match_anchors(most, _CORE_TWICE, _CORE_HOT)

    def answer(table: pa.Table) -> Iterator[dict]:
        """Flags, for every window of every sent text, that it occurs twice or more; and the cores' flags."""
        kinds = table.column("kind").to_numpy()
        if (kinds == _CORE_TWICE).any():
            yield from cores(table.filter(pa.array(kinds == _CORE_TWICE)))
            table = table.filter(pa.array(kinds != _CORE_TWICE))
        classes: dict[tuple[int, int, int, bytes], int] = {}
        copies: list[int] = []
        member: list[int] = []
        rows: list[int] = []
        columns = [table.column(c) for c in ("prints", "before", "windows", "multi", "texts")]
        for i in range(table.num_rows):
            prints, before, windows, multi, texts = (c[i].as_py() for c in columns)
            before, windows = np.frombuffer(before, "<u4").tolist(), np.frombuffer(windows, "<u4").tolist()
            at = 0
            for key, b, w, m in zip(unpack40(prints).tolist(), before, windows, unbits(multi, len(before)).tolist(), strict=True):
                text = (key, b, w, texts[at : at + w + n - 1])
                at += w + n - 1
                k = classes.setdefault(text, len(copies))
                if k == len(copies):
                    copies.append(0)
                copies[k] += 1 + m
                member.append(k)
            rows.append(len(before))
        flags = repeated_windows([c[1:] for c in classes], copies, n, [c[0] for c in classes])
        at = 0
        for spans, kind, bucket, chunk, size in zip(rows, *(table.column(c).to_pylist() for c in ("kind", "bucket", "chunk", "size")), strict=True):
            own = np.concatenate([flags[k] for k in member[at : at + spans]])
            at += spans
            if own.any():
                yield {"kind": kind, "bucket": bucket, "chunk": chunk, "size": size, "flags": bits(own)}

    return answer


def repeated_windows(texts: list[tuple[int, int, bytes]], copies: list[int], n: int, keys: list | None = None) -> list[np.ndarray]:
    """For distinct texts ``(bytes before the anchor, windows, text)`` that occur
    ``copies`` times, the flags of the windows that occur twice or more. Texts with different
    ``keys`` (by default the anchor's substring) share no window."""
    flags = [np.full(w, c > 1) for (_, w, _), c in zip(texts, copies, strict=True)]
    seed = max(1, n // 3)
    # texts alone with their key are settled
    groups: dict = {}
    for k, (b, _, text) in enumerate(texts):
        groups.setdefault(text[b : b + seed] if keys is None else keys[k], []).append(k)
    shared: list[int] = []
    size = 0
    for group in [*(g for g in groups.values() if len(g) > 1), None]:
        if shared and (group is None or size > SORT_BYTES):
            for k, found in zip(shared, _flags_of(texts, copies, shared, n), strict=True):
                flags[k] = found
            shared, size = [], 0
        shared += group or []
        size += sum(len(texts[k][2]) for k in group or [])
    return flags


def _flags_of(texts: list[tuple[int, int, bytes]], copies: list[int], shared: list[int], n: int) -> list[np.ndarray]:
    """Window flags of the texts ``shared``, which hold whole anchor groups."""
    data = np.frombuffer(b"".join(texts[k][2] for k in shared), np.uint8)
    size = np.array([len(texts[k][2]) for k in shared])
    before = np.array([texts[k][0] for k in shared])
    windows = np.array([texts[k][1] for k in shared])
    weight = np.array([copies[k] for k in shared])
    at = np.cumsum(size) - size + before
    places, forward = suffixes.sort(data, at, size - before, True)
    back_places, backward = suffixes.sort(data, at, before, False)
    found = [np.zeros(w, bool) for w in windows.tolist()]
    most = before  # windows start from most to least bytes before the anchor
    least = before - windows + 1
    right, left = np.zeros(len(shared), np.int64), np.zeros(len(shared), np.int64)
    for b in range(int(least.min()), int(most.max()) + 1):
        active = np.flatnonzero((least <= b) & (b <= most))
        if not len(active):
            continue
        right[places] = np.cumsum(forward < n - b)
        left[back_places] = np.cumsum(backward < b)
        pair = right[active] * (len(shared) + 1) + left[active]
        _, inverse = np.unique(pair, return_inverse=True)
        often = np.bincount(inverse, weights=weight[active])[inverse] > 1
        for i in active[often].tolist():
            found[i][before[i] - b] = True
    return found


def _remove(n: int, buckets: int):
    def cut(chunk: Chunk, answers: pa.Table) -> Iterator[dict]:
        lost = np.zeros(len(chunk.data), bool)
        if answers.num_rows:
            r = _Runs(chunk, n, buckets)
            starts = _cold_spans(chunk, r, answers, n).repeated(answers, _SORTED)
            starts += _Cores(r, answers, n, buckets).spans(chunk, answers).repeated(answers, _CORE_SORTED)
            if starts:
                lost = covered(np.concatenate(starts), n, len(chunk.data))
        for i, doc_id in enumerate(chunk.ids.to_pylist()):
            a, b = chunk.offsets[i], chunk.offsets[i + 1]
            own = lost[a:b]
            first, last = runs(own)
            yield {
                "doc_id": doc_id,
                "n_bytes": int(b - a),
                "n_removed": int(own.sum()),
                "spans": [{"start": x, "end": y} for x, y in zip(first.tolist(), last.tolist(), strict=True)],
                "kept": chunk.data[a:b][~own].tobytes(),
            }

    return cut


def remove_repeated_bytes(docs: DataFrame, n: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (maximal
    removed byte runs) and ``kept`` (the remaining bytes). ``docs`` must be
    re-readable (see ``chunks``). Anchors with more than ``sort_bytes`` of texts are hot."""
    if n < 3:
        raise ValueError("a window has at least three bytes")
    spark = docs.sparkSession
    buckets = BUCKETS_PER_TASK * tasks_for(spark)
    docs = prepare(docs)
    sent = from_chunks(docs, _send_anchors(n, buckets), _SENT, _SENT_ARROW, chunk_bytes)
    most = sort_bytes // (2 * n)
    hits = materialize(spark, at_buckets(sent, buckets, _match_anchors(most), _ANSWER, _ANSWER_ARROW))
    parts = chunked(docs, chunk_bytes)
    spans = with_answers(parts, hits, _send_spans(n, buckets), _SPANS, _SPANS_ARROW)
    hits = hits.unionByName(materialize(spark, at_buckets(spans, buckets, _sort_spans(n, most), _ANSWER, _ANSWER_ARROW)))
    spans = with_answers(parts, hits, _send_hot_spans(n, buckets), _SPANS, _SPANS_ARROW)
    repeated = at_buckets(spans, buckets, _sort_spans(n, most), _ANSWER, _ANSWER_ARROW)
    return with_answers(parts, hits.unionByName(repeated), _remove(n, buckets), _RESULT, _RESULT_ARROW)


def suffix_report(docs: DataFrame) -> DataFrame:
    """Digest of :func:`remove_repeated_bytes` per document."""
    return remove_repeated_bytes(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
