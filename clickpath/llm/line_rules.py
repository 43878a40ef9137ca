"""Quality rules, lines first.

Every line (texts are cut at ``\\n``) that has words is judged by itself:

* punctuation: a fifth of its words or more carry runs of odd marks, or it is long and has
  no sentence mark at all;
* navigation: it is short and half of its words are those of menus, or a third of its
  words are separators, as in lists of links;
* boilerplate: it is short and holds a licence, copyright, cookie or sharing phrase.

Lines that fail are removed. A document is rejected if the lines took more than
``LOSS_PERCENT`` of its words, or if the base counts of the whole text fail: fewer
than ``MIN_WORDS`` words, or more than ``REPEAT_PERCENT`` of the words inside
eight-word windows that occur twice or more.

The rules are RE2 patterns over Arrow columns, so they are the same in SQL. Equal
lines and windows are found exactly, not by hashes: lines and words get their number
in a dictionary, and the number of a window comes from the numbers of its two
halves, doubled three times. One narrow pass, no shuffle; a task works on
``BLOCK_BYTES`` of text at a time, or on one longer document, whose memory is about
100 bytes for each of its words.

Defined results: null and empty texts have no words, fail the base counts and are
rejected; their cleaned text is null or empty. Lines without words are kept. Rows that
repeat an id, with or without id, are judged each on its own; an empty table gives no
rows; extra columns are ignored; documents are never cut, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import SPACE_WORDS, byte_chunks, byte_table, covered, keep_rows, text_bytes, words

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
LOSS_PERCENT = 50
BLOCK_BYTES = 4 << 20

#: punctuation: this share of words with odd marks, two at least; or so many words without a sentence mark
ODD_PERCENT, ODD_LEAST, LONG_LINE = 20, 2, 40
#: most words of a menu or boilerplate line; share of separators, two at least, among the words of a list of links
NAVIGATION_WORDS, BOILERPLATE_WORDS, SEPARATOR_PERCENT = 12, 30, 33

ODD_MARKS = r"[#$%&*<>|~^=_{}\\\[\]]{2,}|[!?]{2,}"
SENTENCE_MARKS = r"[.!?,;:\x{2026}\x{3002}\x{FF01}\x{FF1F}]"
MENU_WORDS = (
    r"(?i)\b(?:home|menu|login|logout|log in|log out|sign in|sign up|register|search|contact|contacts|about|about us|sitemap|"
    r"faq|help|support|next|previous|back|top|prev|categories|archive|archives|tags|account|cart|checkout|share|tweet|"
    r"print|newsletter|subscribe|privacy|terms|imprint|impressum|startseite|accueil|inicio|contacto|kontakt)\b"
)
SEPARATORS = r"(?:^|[ \t])(?:\||»|›|>|>>|•|·|/)(?:[ \t]|$)"
PHRASES = (
    r"(?i)all rights reserved|licen[sc]ed under|under the terms of|released under the|general public licen[sc]e|creative commons|"
    r"copyright|©|\(c\) ?[12][0-9]{3}|cookie policy|use of cookies|uses cookies|accept cookies|privacy policy|terms of (?:use|service)|terms and conditions|"
    r"click here|read more|learn more|sign up for|subscribe to|powered by|enable javascript|lorem ipsum|share this|follow us|"
    r"back to top|skip to (?:main )?content|leave a (?:comment|reply)|page not found"
)
RULES = ("punctuation", "navigation", "boilerplate")

_SYMBOLS = ~byte_table(b"#*$%&|<>")
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("n_lost_words", pa.int64()), ("failed_lines", pa.list_(pa.struct([("line", pa.int32()), ("rule", pa.string())]))), ("text", pa.string()),
])
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lost_words long, "
    "failed_lines array<struct<line:int,rule:string>>, text string"
)


def _counts(lines: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)


def _holds(lines: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False).astype(bool)


def line_failures(lines: pa.Array, n_words: np.ndarray) -> np.ndarray:
    """For every line 0, or 1 + the place in ``RULES`` of the first rule that it fails."""
    odd = _counts(lines, ODD_MARKS)
    bare = (n_words >= LONG_LINE) & ~_holds(lines, SENTENCE_MARKS)
    punctuation = ((odd >= ODD_LEAST) & (100 * odd >= ODD_PERCENT * n_words)) | bare
    short = n_words <= NAVIGATION_WORDS
    separators = _counts(lines, SEPARATORS)
    navigation = (short & (2 * _counts(lines, MENU_WORDS) >= n_words)) | ((separators >= 2) & (100 * separators >= SEPARATOR_PERCENT * n_words))
    boilerplate = (n_words <= BOILERPLATE_WORDS) & _holds(lines, PHRASES)
    return np.select([n_words == 0, punctuation, navigation, boilerplate], [0, 1, 2, 3], 0)


def _numbers(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def repeated_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words per document inside windows (of a power of two words) that its text holds twice or more."""
    out = np.zeros(len(first) - 1, np.int64)
    if len(start) < window:
        return out
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    text = pa.py_buffer(data[SPACE_WORDS[data]].tobytes())
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.tobytes()), text])
    number = spelled.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = 1
    while size < window:
        number = _numbers(number[:-size] * (int(number.max()) + 1) + number[size:])
        size *= 2
    per_doc = np.maximum(np.diff(first) - window + 1, 0)
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    at = np.arange(len(doc)) - (np.cumsum(per_doc) - per_doc)[doc] + first[:-1][doc]
    _, group, count = np.unique(doc * (int(number.max()) + 1) + number[at], return_inverse=True, return_counts=True)
    hit = covered(at[count[group] > 1], window, len(start))
    sums = np.concatenate(([0], np.cumsum(hit)))
    return sums[first[1:]] - sums[first[:-1]]


def judge(ids: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """Counts, failed lines and cleaned text of a block of documents."""
    filled = pc.fill_null(text.cast(pa.large_string()), "")
    data, offsets = text_bytes(filled)
    n = len(offsets) - 1
    start, end, first = words(data, offsets, SPACE_WORDS)
    n_words = np.diff(first)
    sums = lambda flags: np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets]
    symbols = np.diff(sums(_SYMBOLS[data]))
    chars = np.diff(sums(SPACE_WORDS[data] & ((data & 0xC0) != 0x80)))

    split = pc.split_pattern(filled, "\n")
    lines, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    line_doc = np.repeat(np.arange(n), np.diff(bounds))
    breaks = np.concatenate(([0], np.cumsum(data == 10, dtype=np.int64)))
    word_doc = np.repeat(np.arange(n), n_words)
    line_words = np.bincount(breaks[start] + word_doc, minlength=len(lines))
    with_words = line_words > 0
    number = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = line_doc * (len(lines) + 1) + number
    distinct = np.bincount(line_doc[with_words][np.unique(key[with_words], return_index=True)[1]], minlength=n)
    dup = np.bincount(line_doc[with_words], minlength=n) - distinct

    failed = line_failures(lines, line_words)
    lost = np.bincount(line_doc, weights=line_words * (failed > 0), minlength=n).astype(np.int64)
    cleaned, reasons = text.to_pylist(), [[] for _ in range(n)]
    bad = np.flatnonzero(failed)
    for i in bad.tolist():
        d = int(line_doc[i])
        reasons[d].append({"line": i - int(bounds[d]), "rule": RULES[failed[i] - 1]})
    for d in np.unique(line_doc[bad]).tolist():
        own = lines.slice(int(bounds[d]), int(bounds[d + 1] - bounds[d])).filter(pa.array(failed[bounds[d] : bounds[d + 1]] == 0))
        cleaned[d] = "\n".join(own.to_pylist())
    repeats = repeated_words(data, start, end, first)
    columns = [ids, *(pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, dup, repeats, lost)), reasons, cleaned]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, _RESULT, strict=True)], schema=_RESULT)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def clean_lines(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``doc_id``, the base counts, ``n_lost_words``, ``failed_lines`` (line
    number from 0 and rule), the cleaned ``text``, ``base_failed`` and ``kept``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in byte_chunks(offsets, block_bytes):
                yield judge(batch.column("doc_id").slice(a, b - a), batch.column("text").slice(a, b - a))

    own = keep_rows(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = own.mapInArrow(run, _SCHEMA).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= LOSS_PERCENT * F.col("n_words")))


def quality_rules_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict per document."""
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words")
