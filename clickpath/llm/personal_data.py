"""Personal data by weak supervision.

Candidates are the base patterns (email, ip, card, phone, with their checks)
and looser ones: secrets, dashed or spelled-out contacts, long numbers. Five
labelers vote on each (yes, no, no opinion): the strict pattern, the check
(digits, octets, Luhn, entropy), a gazetteer of words inside, the context
before, and the shape. Votes are counted per pattern over all documents, so
the driver gets a table bounded by the number of vote patterns.
Expectation-maximisation estimates how reliable each labeler is and the chance
that a pattern is personal data; a logistic span classifier is trained on
those chances and decides on every candidate. Base spans always stay; the
classifier adds others.

Positions are code points, ends exclusive. Defined results: null and empty
texts hold nothing; an empty table trains a model that adds nothing; repeated
rows get a row each; extra columns are kept by :func:`redact` and ignored
elsewhere. Every pattern is linear in the text.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import keep_rows, released

KINDS = ["email", "ip", "card", "phone"]
#: kinds that only the classifier can add
LOOSE = ["secret", "contact", "number"]
ALL_KINDS = KINDS + LOOSE

_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# no match starts inside a run of digits that fails at its start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SECRET = re.compile(
    r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?:gh[opsu]_|sk-|xox[abp]-)[A-Za-z0-9-]{16,})"
    r"|(?:token|password|passwd|secret|api[_-]?key)[\x20]?[=:][\x20]?[\"']?(?P<value>[^\s\"']{6,})",
    re.IGNORECASE,
)
_SPELLED = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9_-]{0,63}(?:\x20at\x20|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]{1,63}(?:\x20dot\x20|\x20?[(\[]dot[)\]]\x20?)[A-Za-z]{2,12}(?![A-Za-z])")
_LONG_NUMBER = re.compile(r"(?<![0-9A-Za-z.+-])[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){2,3}(?![0-9.-])|(?<![0-9A-Za-z.+-])[0-9]{7,15}(?![0-9A-Za-z.-])")

# fixed word lists of the gazetteer and context labelers
_DOMAIN_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk"}
_CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "90", "91")
_CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
_CUES = {"email", "mail", "e-mail", "call", "phone", "tel", "fax", "mobile", "contact", "card", "visa", "ip", "address", "token", "password", "passwd", "secret", "key", "ssn", "account"}
_ANTI_CUES = {"version", "license", "section", "page", "figure", "chapter", "table", "isbn", "year", "no", "release"}
_PLACEHOLDERS = ("xxxx", "****", "changeme", "<", "your", "none", "null")


# ---------------------------------------------------------------- base spans

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in text.split(".")))


def _emails(text: str):
    last = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last, True


def _checked(pattern, check):
    def find(text: str):
        for m in pattern.finditer(text):
            yield m.start(), m.end(), check(m.group())

    return find


def _is_card(text: str) -> bool:
    digits = _only_digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


_FINDERS = {
    "email": _emails,
    "ip": _checked(_IP, _octets),
    "card": _checked(_CARD, _is_card),
    "phone": _checked(_PHONE, lambda t: 8 <= len(_only_digits(t)) <= 15),
}


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passes its check), leftmost and not overlapping per kind."""
    out = []
    digits = _DIGIT.search(text) is not None
    for k, kind in enumerate(KINDS):
        if (kind == "email" and "@" in text) or (kind == "phone" and "+" in text and digits) or (kind in ("ip", "card") and digits):
            out += [(k, a, b, ok) for a, b, ok in _FINDERS[kind](text)]
    return out


# ---------------------------------------------------------------- candidates and votes

def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base): base spans and looser candidates outside them."""
    matches = base_matches(text)
    spans = [(k, a, b, True) for k, a, b, ok in matches if ok]
    taken = sorted((a, b) for _, a, b, _ in spans)
    loose = [(4, *(m.span("value") if m.group("value") else m.span())) for m in _SECRET.finditer(text)] if _maybe_secret(text) else []
    if " at " in text or "(at)" in text or "[at]" in text:
        loose += [(5, m.start(), m.end()) for m in _SPELLED.finditer(text)]
    loose += [(k, a, b) for k, a, b, ok in matches if not ok and b - a >= 7]
    if _DIGIT.search(text):
        loose += [(6, m.start(), m.end()) for m in _LONG_NUMBER.finditer(text)]
    at, last = 0, 0
    for k, a, b in sorted(loose, key=lambda s: (s[1], s[0], -s[2])):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= last and (at == len(taken) or taken[at][0] >= b):
            spans.append((k, a, b, False))
            last = b
    return spans


_SECRET_HINTS = re.compile(r"AKIA|gh[opsu]_|sk-|xox|token|passw|secret|api[_-]?key", re.IGNORECASE)


def _maybe_secret(text: str) -> bool:
    return _SECRET_HINTS.search(text) is not None


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in (text.count(x) for x in set(text))) if n else 0.0


def votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    """Votes of the five labelers (1 yes, -1 no, 0 no opinion), then coarse features
    (length and share of digits) of the classifier."""
    span = text[start:end]
    name, digits = ALL_KINDS[kind], _only_digits(span)
    if name == "secret":
        pattern = 1 if span.startswith("AKIA") or (len(span) >= 16 and span.isalnum()) else 0
        check = 1 if entropy(span) >= 3.0 and digits else -1
    elif name == "contact":
        pattern, check = 0, 1 if " at " not in span or " dot " in span else -1
    elif name == "number":
        pattern, check = 0, 1 if len(digits) == 9 and len(set(digits)) > 3 else -1
    else:
        pattern, check = (1, 1) if base else (-1, -1)
    lowered = span.lower()
    if name == "email":
        gazetteer = 1 if lowered.rsplit(".", 1)[-1] in _DOMAIN_ENDINGS else 0
    elif name == "contact":
        gazetteer = 1 if re.split(r"[\x20()\[\]]+", lowered.strip(" )]"))[-1] in _DOMAIN_ENDINGS else -1
    elif name == "phone":
        gazetteer = 1 if digits.startswith(_CALLING_CODES) else 0
    elif name == "card":
        gazetteer = 1 if digits.startswith(_CARD_PREFIXES) and len(digits) >= 13 else 0
    elif name == "secret":
        gazetteer = -1 if any(p in lowered for p in _PLACEHOLDERS) else 1 if span.startswith(("AKIA", "gh", "sk-", "xox")) else 0
    else:
        gazetteer = -1 if len(set(digits)) <= 2 else 0
    before = re.findall(r"[a-z-]+", text[max(0, start - 40) : start].lower())[-4:]
    context = 1 if _CUES.intersection(before) else -1 if _ANTI_CUES.intersection(before) else 0
    share = len(digits) / max(1, len(span))
    shape = 1 if 7 <= len(span) <= 64 and (share > 0.6 or (span.isalnum() and 0.1 < share < 0.9) or "@" in span) else -1 if len(span) < 6 or len(span) > 200 else 0
    size = 0 if len(span) < 12 else 1 if len(span) < 24 else 2
    return (pattern, check, gazetteer, context, shape, size, int(share * 2.999))


LABELERS = 5


# ---------------------------------------------------------------- model

@dataclass
class Model:
    """Weights of the span classifier; ``reliability`` holds, per labeler, the
    chance of each vote (-1, 0, 1) for other text and for personal data."""

    weights: np.ndarray | None = None
    reliability: np.ndarray | None = None
    decisions: dict = field(default_factory=dict)

    def adds(self, kind: int, vote: tuple[int, ...]) -> bool:
        if self.weights is None:
            return False
        key = (kind, vote)
        if key not in self.decisions:
            self.decisions[key] = bool(_encode(kind, vote) @ self.weights >= 0.0)
        return self.decisions[key]


def _encode(kind: int, vote: tuple[int, ...]) -> np.ndarray:
    x = np.zeros(1 + len(ALL_KINDS) + LABELERS * 2 + 6)
    x[0] = 1
    x[1 + kind] = 1
    at = 1 + len(ALL_KINDS)
    for j, v in enumerate(vote[:LABELERS]):
        x[at + 2 * j] = v > 0
        x[at + 2 * j + 1] = v < 0
    x[at + 2 * LABELERS + vote[LABELERS]] = 1
    x[at + 2 * LABELERS + 3 + min(2, vote[LABELERS + 1])] = 1
    return x


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...]]], counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Chance of personal data for every vote pattern, and the labelers' reliabilities."""
    v = np.array([p[1][:LABELERS] for p in patterns]) + 1  # 0 no, 1 no opinion, 2 yes
    kind = np.array([p[0] for p in patterns])
    chance = 1.0 / (1.0 + np.exp(-1.5 * (v - 1).sum(1)))  # start: weighted majority
    rate = np.zeros((LABELERS, 2, 3))
    for _ in range(rounds):
        mass = np.stack((counts * (1 - chance), counts * chance))
        for j in range(LABELERS):
            for y in (0, 1):
                rate[j, y] = np.bincount(v[:, j], weights=mass[y], minlength=3) + 1.0
            rate[j] /= rate[j].sum(1, keepdims=True)
        yes = np.bincount(kind, weights=mass[1], minlength=len(ALL_KINDS)) + 1.0
        no = np.bincount(kind, weights=mass[0], minlength=len(ALL_KINDS)) + 1.0
        score = np.log(yes / no)[kind] + sum(np.log(rate[j, 1, v[:, j]] / rate[j, 0, v[:, j]]) for j in range(LABELERS))
        after = 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(after - chance).max() < 1e-9:
            break
        chance = after
    return chance, rate


def train_classifier(patterns, counts: np.ndarray, chance: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels, weighted by counts (Newton steps)."""
    x = np.array([_encode(k, v) for k, v in patterns])
    w = np.zeros(x.shape[1])
    weight = np.minimum(counts, 1000.0)  # no pattern drowns the others
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (p - chance)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame) -> Model:
    """Votes of all candidates of all documents, counted per pattern; the driver gets
    at most one row per vote pattern."""

    def count(batches):
        seen: dict[tuple, int] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for k, a, b, base in candidates(text) if text else ():
                    key = (k, *votes(text, k, a, b, base))
                    seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(k) for k in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"]
        )

    found = keep_rows(docs, "text").mapInArrow(released(count), "pattern array<int>, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted((tuple(r["pattern"]), r["n"]) for r in found.collect())
    if not rows:
        return Model()
    patterns = [(p[0], p[1:]) for p, _ in rows]
    counts = np.array([float(n) for _, n in rows])
    chance, rate = expectation_maximisation(patterns, counts)
    return Model(train_classifier(patterns, counts, chance), rate)


def spans_of(text: str, model: Model) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of a text, by kind and start."""
    return sorted((k, a, b, base) for k, a, b, base in candidates(text) if base or model.adds(k, votes(text, k, a, b, base)))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])


def find_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, base), by kind and start."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            spans = [
                [{"kind": ALL_KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in spans_of(text, shared.value)] if text else []
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "spans"])

    rows = keep_rows(docs, "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {id_type}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def mask(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """``text`` with every group of overlapping spans replaced by the kind of its first one."""
    out, at = [], 0
    for k, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"<{ALL_KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model, length: str | None = None) -> DataFrame:
    """``docs`` with all spans in ``text`` masked; the column ``length``, if named, is set
    to the new number of characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = [t and mask(t, spans_of(t, shared.value)) for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    out = docs.mapInArrow(released(run), docs.schema)
    if length is not None:
        out = out.withColumn(length, F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema[length].dataType))
    return out


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every document."""
    found = find_spans(docs, fit(docs))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(F.filter(base, _is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", F.transform(base, text)).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", text)).alias("spans"),
    )
