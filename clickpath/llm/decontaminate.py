"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the normalised test items is built from a bounded block of
item words (``block_words``); a larger benchmark is cut into blocks, and the
documents stream through one automaton after the other without a shuffle.
Each document's words walk the automaton, which yields the length of the
longest item match ending at every word. Where it reaches ``n`` words (or a
whole shorter item) the words are hit.

Defined results: null or empty texts have no words; null items have no
windows; items without an id count for hits but are not listed; repeated ids
are listed once; an empty benchmark hits nothing; an item longer than a block
is cut into pieces that overlap by ``n - 1`` words, so no window is lost.
Repeated document rows each get their own row. Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from clickpath.llm.common import extended, keep_rows, released, runs

NGRAM = 13
#: item words in one automaton; bounds the broadcast (about 200 bytes a word)
BLOCK_WORDS = 1_000_000

# every byte that is not part of a word becomes a blank, A-Z become a-z
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of digits, ASCII letters and non-ASCII characters."""
    return text.encode().translate(_NORMAL).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton over the words of the items.

    For every state it knows which items hold the ``n``-word window that ends
    there, and which items shorter than ``n`` end there as a whole.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.n = n
        self.ids = [item_id for item_id, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.shortest = min((min(n, len(words)) for words in coded if words), default=n)
        self._annotate(coded)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(w)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, w, known)
        state = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return state

    def _clone(self, p: int, w: int, q: int) -> int:
        """Split state ``q`` so that the string through ``p`` gets its own state."""
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def _annotate(self, coded: list[list[int]]) -> None:
        n, size = self.n, len(self.next)
        self.window_state = [-1] * size  # the state of the last n words
        self.short_state = [-1] * size  # nearest state on the link path with whole short items
        self.window_items: dict[int, set[int]] = {}
        self.short_items: dict[int, list[tuple[int, int]]] = {}
        order = sorted(range(size), key=self.length.__getitem__)
        for v in order:
            up = self.link[v]
            if self.length[v] >= n:
                self.window_state[v] = v if self.length[up] < n else self.window_state[up]
        for item, words in enumerate(coded):
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= n:
                    self.window_items.setdefault(self.window_state[state], set()).add(item)
            if 0 < len(words) < n:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short_items.setdefault(state, []).append((len(words), item))
        for v in order[1:]:
            self.short_state[v] = v if v in self.short_items else self.short_state[self.link[v]]

    def match(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Walk a run of known words: (hit intervals, items, longest match)."""
        nxt, link, length, n = self.next, self.link, self.length, self.n
        state = size = longest = 0
        hits: list[tuple[int, int]] = []
        found: set[int] = set()
        seen = -1
        for i, w in enumerate(codes):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            if size > longest:
                longest = size
            if size >= n:
                hits.append((i + 1 - n, i + 1))
                at = self.window_state[state]
                if at != seen:
                    found |= self.window_items.get(at, set())
                    seen = at
            at = self.short_state[state]
            while at > 0:
                for k, item in self.short_items[at]:
                    if k <= size:
                        hits.append((i + 1 - k, i + 1))
                        found.add(item)
                at = self.short_state[link[at]]
        return hits, found, longest

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[int], int]:
        """(hit flag per word or None, items, longest match) of one document."""
        if not self.ids or not words:
            return None, set(), 0
        get = self.vocabulary.get
        codes = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
        starts, ends = runs(codes >= 0)
        long_enough = ends - starts >= self.shortest
        hit, found, longest = None, set(), 0
        for s, e in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            spans, items, most = self.match(codes[s:e].tolist())
            longest = max(longest, most)
            if spans:
                if hit is None:
                    hit = np.zeros(len(words), bool)
                for a, b in spans:
                    hit[s + a : s + b] = True
                found |= items
        return hit, found, longest


def _blocks(benchmark: DataFrame, n: int, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words, streamed in id order."""
    rows = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .where(F.col("text").isNotNull())
        .orderBy("item_id", "text")
    )
    block: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in rows.toLocalIterator():
        words = normal_words(row["text"])
        if not words:
            continue
        pieces = [words]
        if len(words) > block_words:
            step = max(1, block_words - n + 1)
            pieces = [words[a : a + block_words] for a in range(0, max(1, len(words) - n + 1), step)]
        for piece in pieces:
            if block and size + len(piece) > block_words:
                yield block
                block, size = [], 0
            block.append((row["item_id"], piece))
            size += len(piece)
    if block:
        yield block


_FOUND = [
    StructField("n_words", LongType()),
    StructField("items", ArrayType(StringType())),
    StructField("hits", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
    StructField("longest", IntegerType()),
]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = NGRAM,
    block_words: int = BLOCK_WORDS,
    keep: tuple[str, ...] = ("doc_id",),
    keep_text: bool = False,
) -> DataFrame:
    """Per row the columns ``keep``, ``n_words``, ``items`` (ids with an occurring
    window), ``hits`` (maximal runs of hit words) and ``longest`` (words of the
    longest item match seen in runs long enough to hold a window)."""
    found = keep_rows(docs, *keep, "text")
    found = found.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _FOUND])
    schema = extended(found, [*keep, "text"], *_FOUND)
    sc = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, n, max(block_words, n))
    block: list | None = next(blocks, [])
    while block is not None:
        following = next(blocks, None)
        found = found.mapInArrow(released(_scanner(sc.broadcast(block), n, keep, keep_text or following is not None)), schema)
        block = following
    return found if keep_text else found.drop("text")


_automata: dict[str, ItemAutomaton] = {}


def _scanner(shared, n: int, keep: tuple[str, ...], keep_text: bool):
    key = uuid.uuid4().hex

    def scan(batches):
        automaton = _automata.get(key)
        if automaton is None:  # built once per Python worker; the last block only is kept
            _automata.clear()
            automaton = _automata[key] = ItemAutomaton(shared.value, n)
        for batch in batches:
            n_words, items, hits, longest = [], [], [], []
            for text, old_items, old_hits, old_longest in zip(
                batch.column("text").to_pylist(),
                batch.column("items").to_pylist(),
                batch.column("hits").to_pylist(),
                batch.column("longest").to_pylist(),
                strict=True,
            ):
                words = normal_words(text)
                hit, found, most = automaton.scan(words)
                n_words.append(len(words))
                old_items, old_hits = old_items or [], old_hits or []
                if hit is not None:
                    for old in old_hits:
                        hit[old["start"] : old["end"]] = True
                    a, b = runs(hit)
                    old_hits = [{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)]
                    ids = {automaton.ids[i] for i in found} - {None}
                    old_items = sorted(ids.union(old_items))
                items.append(old_items)
                hits.append(old_hits)
                longest.append(max(most, old_longest or 0))
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    batch.column("text") if keep_text else pa.nulls(len(n_words), pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(hits, spans),
                    pa.array(longest, pa.int32()),
                ],
                [*keep, "text", "n_words", "items", "hits", "longest"],
            )

    return scan


def _cut(text: str, hits: list[dict]) -> str:
    """``text`` without the characters from the first to the last word of each hit run."""
    raw = text.encode()
    spans = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    out, at = [], 0
    for hit in hits:
        out.append(raw[at : spans[hit["start"]][0]])
        at = spans[hit["end"] - 1][1]
    out.append(raw[at:])
    return b"".join(out).decode()


def remove_spans(found: DataFrame, min_span: int = 1) -> DataFrame:
    """Texts of ``find_contamination(keep_text=True)`` without hit runs of at
    least ``min_span`` words; documents without such a run pass unchanged."""

    def cut(batches):
        for batch in batches:
            texts = []
            for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist(), strict=True):
                hits = [h for h in hits if h["end"] - h["start"] >= min_span]
                texts.append(_cut(text, hits) if text and hits else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text", "hits").mapInArrow(cut, f"doc_id {id_type}, text string")


def hit_words():
    """Number of hit words of a row of :func:`find_contamination`."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + (h["end"] - h["start"]))


def is_contaminated(n_hit, n_words):
    """At least one hit word, and hits cover 5 % of the words or more."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of :func:`find_contamination` per document."""
    found = find_contamination(docs, benchmark)
    n_hit = hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )
