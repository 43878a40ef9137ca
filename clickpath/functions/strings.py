"""String helpers as Column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c: ColumnOrName) -> Column:
    """True for null or the empty string."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def is_not_empty(c: ColumnOrName) -> Column:
    """Negation of :func:`is_empty`; never null."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def trim_comma(c: ColumnOrName) -> Column:
    """Drop one leading and one trailing comma (both ends, when both exist)."""
    return F.regexp_replace(_col(c), r"\A,|,\z", "")


def pad_two(c: ColumnOrName) -> Column:
    """Prefix a ``0`` unless the text is exactly two characters long."""
    c = _col(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def _java_split(c: Column, delimiter: str) -> Column:
    """``split`` on a literal delimiter with trailing empty parts removed.

    Java's ``String.split`` drops trailing empty strings, Spark's ``split``
    keeps them; stripping trailing delimiters first gives Java's result.
    """
    quoted = re.escape(delimiter)
    stripped = F.regexp_replace(c, f"(?:{quoted})+\\z", "")
    # text made of delimiters only splits into no parts at all; "" into one
    only_delims = (F.length(c) > 0) & (stripped == F.lit(""))
    return F.when(only_delims, F.array().cast("array<string>")).otherwise(F.split(stripped, quoted))


def kv_get(c: ColumnOrName, field: str, delimiter: str = "|") -> Column:
    """Value of the first ``field=value`` fragment of a ``k=v|k=v`` string.

    A fragment counts only when it splits into exactly two parts on ``=``
    (after trailing ``=`` are dropped): ``k=`` and ``k==v`` are skipped,
    ``k=v=`` yields ``v``. No match, or null input, gives null.
    """
    pairs = F.transform(
        _java_split(_col(c), delimiter),
        lambda frag: F.split(F.regexp_replace(frag, r"=+\z", ""), "="),
    )
    hits = F.filter(pairs, lambda p: (F.size(p) == 2) & (p.getItem(0) == F.lit(field)))
    return F.get(F.get(hits, 0), 1)


def kv_set(c: ColumnOrName, field: str, value: ColumnOrName, delimiter: str = "|") -> Column:
    """Replace the first fragment named ``field`` by ``field=value``.

    A missing field is not appended; a null value is written as ``null``. The fragments are re-joined with ``|``
    and trailing empty fragments are dropped, as Java's ``split`` does.
    """
    value = F.coalesce(F.lit(value) if isinstance(value, str) else value, F.lit("null"))
    parts = _java_split(_col(c), delimiter)
    names = F.transform(parts, lambda frag: F.substring_index(frag, "=", 1))
    first = F.array_position(names, field)  # 1-based, 0 when absent
    replaced = F.transform(
        parts,
        lambda frag, i: F.when(i + 1 == first, F.concat(F.lit(field + "="), value)).otherwise(frag),
    )
    return F.array_join(replaced, "|")


def parse_id(c: ColumnOrName) -> Column:
    """Text → ``bigint``; anything but an optional sign and digits (blanks included) → null."""
    c = _col(c)
    return F.when(c.rlike(r"\A[+-]?[0-9]+\z"), c.try_cast("bigint"))


def id_list(c: ColumnOrName) -> Column:
    """Comma-separated ids → ``array<bigint>``; empty and malformed ids are skipped.

    Accepts a text list or a single integer column. For per-row use where the
    list must stay an array; the category counts instead explode the split
    text and cast afterwards, which avoids lambda functions (they run outside
    whole-stage codegen).
    """
    parts = F.split(_col(c).cast("string"), ",")
    ids = F.transform(parts, lambda p: parse_id(p))
    return F.filter(ids, lambda x: x.isNotNull())
