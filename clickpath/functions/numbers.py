"""Numeric helpers: exact half-up rounding and share ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_DEC = "decimal(38,0)"
_TWO_POW_53 = float(2**53)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: Column) -> Column:
    """Exact ``floor(a / b)`` for ``a >= 0``, ``b > 0`` (decimal(38,0) inputs).

    ``a - pmod(a, b)`` is an exact multiple of ``b``, so the decimal quotient
    is an integer and the cast to ``long`` loses nothing.
    """
    a = a.cast(_DEC)
    b = b.cast(_DEC)
    return ((a - F.pmod(a, b)) / b).cast("long")


def _pow2_decimal(q: Column) -> Column:
    """Exact ``2^q`` as decimal(38,0) for 0 <= q <= 124.

    ``pow(2, k)`` is an exact double and its cast to ``long`` is exact for
    k <= 62; two such factors cover the range.
    """
    two = F.lit(2.0)
    low = F.pow(two, F.least(q, F.lit(62))).cast("long").cast(_DEC)
    high = F.pow(two, F.greatest(q - 62, F.lit(0))).cast("long").cast(_DEC)
    return low * high


def format_double(c: ColumnOrName, scale: int = 2) -> Column:
    """Round half-up to ``scale`` decimals on the exact binary value of a double.

    ``1.005`` is stored as 1.00499999999999989…, so it rounds to ``1.0``, and
    ``6.55`` (6.5499999…) to one decimal gives ``6.5``. Spark's ``round``
    rounds the shortest decimal text instead and gives 1.01 / 6.6.

    Method: write ``|x| = m / 2^q`` with an integer ``m < 2^55`` (scaling by a
    power of two is exact, ``q = 53 - floor(log2 |x|)``), then
    ``N = floor((2·m·10^s + 2^q) / 2^(q+1))`` in decimal(38,0) arithmetic is the
    exact half-up result in units of ``10^-s``. Values whose scaled size
    reaches 2^53 come back unchanged (no double carries a finer digit), values
    below a quarter unit give 0.
    """
    if not 0 <= scale <= 20:
        raise ValueError("scale must be within 0..20")
    x = _col(c)
    a = F.abs(x)
    unit = float(10**scale)
    q = (F.lit(53) - F.floor(F.log2(a))).cast("int")
    m = (a * F.pow(F.lit(2.0), q)).cast("long")
    numer = m.cast(_DEC) * F.lit(2 * 10**scale).cast(_DEC) + _pow2_decimal(q)
    n = int_div(numer, _pow2_decimal(q + 1))
    rounded = F.signum(x) * (n.cast("double") / F.lit(unit))
    return (
        F.when(x.isNull() | F.isnan(x), x)
        .when(a * F.lit(unit) >= F.lit(_TWO_POW_53), x)
        .when(a * F.lit(unit) < F.lit(0.25), F.lit(0.0))
        .otherwise(rounded)
    )


def ratio(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part / total`` rounded half-up to 2 decimals; null when ``total`` is 0.

    ``(200·n + t) div (2·t)`` is the exact half-up of the rational ``n/t`` in
    hundredths, the same in every engine.
    """
    if isinstance(part, str) and isinstance(total, str):
        # one SQL expression (cheaper to declare); `div` is Spark's exact integral division
        n, t = f"CAST({part} AS BIGINT)", f"CAST({total} AS BIGINT)"
        return F.expr(f"CASE WHEN {t} > 0 THEN (({n} * 200 + {t}) div ({t} * 2)) / 100.0D END")
    n = _col(part).cast("long")
    t = _col(total).cast("long")
    return F.when(t > 0, int_div(n * 200 + t, t * 2) / F.lit(100.0))
