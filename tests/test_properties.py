"""Property tests (hypothesis): exact rounding helpers against Python's Decimal."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickpath.functions import format_double, ratio

FLOATS = st.floats(min_value=-1e12, max_value=1e12, allow_nan=False, allow_infinity=False)


def _half_up(x: float, scale: int) -> float:
    return float(Decimal(x).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FLOATS, min_size=1, max_size=200), st.integers(min_value=0, max_value=4))
def test_format_double_is_exact_half_up(spark, values, scale):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(format_double("x", scale)).collect()]
    assert got == [_half_up(v, scale) for v in values]


def _ratio(n: int, t: int):
    if t <= 0:
        return None
    q = Fraction(n, t) * 100
    return float((q + Fraction(1, 2)).__floor__()) / 100


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=200))
def test_ratio_is_exact_half_up(spark, pairs):
    pairs = [(min(n, t), t) for n, t in pairs]  # a share never exceeds its total
    df = spark.createDataFrame(pairs, "n long, t long")
    got = df.select(ratio("n", "t"), ratio(F.col("n"), F.col("t"))).collect()
    want = [_ratio(n, t) for n, t in pairs]
    assert [r[0] for r in got] == want  # SQL-expression form (column names)
    assert [r[1] for r in got] == want  # Column form
