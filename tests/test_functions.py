from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.functions import (
    after,
    before,
    date_hour,
    format_date,
    format_date_key,
    format_double,
    format_time,
    format_time_minute,
    id_list,
    is_empty,
    is_not_empty,
    kv_get,
    kv_set,
    minus,
    pad_two,
    parse_date_key,
    parse_time,
    ratio,
    trim_comma,
    truncate_to_second,
)
from tests.conftest import ts


def _one_col(spark, values, typ=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("s", typ)]))


def _apply(spark, values, fn, typ=T.StringType()):
    df = _one_col(spark, values, typ)
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_empty_checks(spark):
    vals = [None, "", "a", " "]
    assert _apply(spark, vals, is_empty) == [True, True, False, False]
    assert _apply(spark, vals, is_not_empty) == [False, False, True, True]


def test_trim_comma_both_ends(spark):
    vals = [",a,", "a", ",a", "a,", ",", ",,", "", None, ",1,2,"]
    assert _apply(spark, vals, trim_comma) == ["a", "a", "a", "a", "", "", "", None, "1,2"]


def test_pad_two(spark):
    vals = ["5", "05", "", "123", None]
    assert _apply(spark, vals, pad_two) == ["05", "05", "0", "0123", None]


def test_kv_get_fragment_rules(spark):
    rec = ["a=1|b=2", "a=|b=2", "a=1|a=2", "a==1|b=2", "a=1=|b=2", "b=2|", "=x|a=9", None, ""]
    assert _apply(spark, rec, lambda c: kv_get(c, "a")) == ["1", None, "1", None, "1", None, "9", None, None]
    assert _apply(spark, rec, lambda c: kv_get(c, "b")) == ["2", "2", None, "2", "2", "2", None, None, None]
    assert _apply(spark, ["x=1;y=2"], lambda c: kv_get(c, "y", ";")) == ["2"]


def test_kv_set_first_match_only(spark):
    rec = ["a=1|b=2", "a=1|a=2", "b=2", "a=1|b=2|", "a|b=2", None]
    out = _apply(spark, rec, lambda c: kv_set(c, "a", "9"))
    assert out == ["a=9|b=2", "a=9|a=2", "b=2", "a=9|b=2", "a=9|b=2", None]


def test_id_list_skips_bad_ids(spark):
    vals = ["1,2", "", None, "1,,2", "x,3", "7"]
    assert _apply(spark, vals, id_list) == [[1, 2], [], None, [1, 2], [3], [7]]
    ints = _apply(spark, [5, None], id_list, T.IntegerType())
    assert ints == [[5], None]


def test_parse_is_strict(spark):
    vals = ["2018-02-03 10:11:12", "2018-02-30 00:00:00", "2018-02-03", "junk", "2018-02-03 10:11:12x", None]
    out = _apply(spark, vals, parse_time)
    assert out == [ts("2018-02-03 10:11:12"), None, None, None, None, None]
    keys = _apply(spark, ["20180203", "20180230", "2018-02-03"], parse_date_key)
    assert [str(k) if k else None for k in keys] == ["2018-02-03", None, None]


def test_fast_parse_equals_format_parse(spark):
    from clickpath.functions.dates import parse_ntz

    vals = [
        "2018-02-03 10:11:12", "2018-02-30 00:00:00", "2018-02-03 24:00:00", "2018-02-03 23:60:00",
        "2018-13-03 10:11:12", "2018-02-03", "2018-02-03T10:11:12", " 2018-02-03 10:11:12", "2018-02-29 00:00:00",
        "2016-02-29 00:00:00", "9999-12-31 23:59:59", "2018-2-3 10:11:12", "", None, "2018-02-03 10:11:12.5",
    ]
    df = _one_col(spark, vals)
    rows = df.select(parse_time("s"), parse_ntz("s", "yyyy-MM-dd HH:mm:ss")).collect()
    assert all(r[0] == r[1] for r in rows)


def test_date_hour_text(spark):
    from clickpath.functions import date_hour_text

    vals = ["2018-02-03 10:11:12", "2018-02-03 7:05", "2018-02-03", None, "x y"]
    assert _apply(spark, vals, date_hour_text) == ["2018-02-03_10", "2018-02-03_7", None, None, "x_y"]


def test_before_after_minus(spark):
    df = spark.createDataFrame(
        [("2018-02-03 10:00:00", "2018-02-03 10:01:05"), ("2018-02-03 10:00:00", "bad"), ("x", "y")], "a string, b string"
    )
    rows = df.select(before("a", "b"), after("a", "b"), minus("b", "a"), minus("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(True, False, 65, -65), (False, False, 0, 0), (False, False, 0, 0)]


def test_formats_and_truncation(spark):
    df = spark.createDataFrame([(ts("2024-03-05 07:08:09.750"),)], "t timestamp_ntz")
    r = df.select(
        format_time(truncate_to_second("t")).alias("a"),
        format_date("t").alias("b"),
        format_date_key("t").alias("c"),
        format_time_minute("t").alias("d"),
        date_hour("t").alias("e"),
        format_time("t").alias("f"),
    ).first()
    assert tuple(r) == ("2024-03-05 07:08:09", "2024-03-05", "20240305", "202403050708", "2024-03-05_07", "2024-03-05 07:08:09")


def test_formats_zone_free(spark):
    df = spark.createDataFrame([(ts("2024-03-10 02:30:00"),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there that day
        r = df.select(format_time("t"), date_hour("t"), format_date("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(r) == ("2024-03-10 02:30:00", "2024-03-10_02", "2024-03-10")


def _exact_half_up(x: float, scale: int) -> float:
    q = Decimal(1).scaleb(-scale)
    return float(Decimal(x).quantize(q, rounding=ROUND_HALF_UP))


def test_format_double_exact_binary_half_up(spark):
    rnd = random.Random(7)
    vals = [1.005, 0.015, 2.675, 6.55, 0.125, 0.375, 2.5, -2.5, -1.005, 0.0, -0.0, 1e-9, 123456.785, 0.5, 1.5]
    vals += [round(rnd.uniform(-1000, 1000), 3) for _ in range(300)]
    vals += [rnd.uniform(0, 10) for _ in range(200)]
    vals += [k / 1000 for k in range(0, 2000, 5)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for scale in (0, 1, 2, 3):
        got = [r[0] for r in df.select(format_double("x", scale)).collect()]
        want = [_exact_half_up(v, scale) for v in vals]
        assert got == want, scale
    # Spark's own round differs on binary near-ties
    assert df.where(F.col("x") == 1.005).select(F.round("x", 2)).first()[0] == 1.01


def test_format_double_special_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (1e300,)], "x double")
    got = [r[0] for r in df.select(format_double("x", 2)).collect()]
    assert got[0] is None and got[1] != got[1] and got[2] == float("inf") and got[3] == 1e300


def test_ratio_exact_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 8), (1, 200), (3, 200), (2, 3), (0, 0), (5, 0), (1, 1)], "n long, t long")
    got = [r[0] for r in df.select(ratio("n", "t")).collect()]
    assert got == [0.13, 0.01, 0.02, 0.67, None, None, 1.0]


def test_ntz_literal_is_zone_free(spark):
    import datetime as dt

    from clickpath.functions.dates import ntz_literal

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        r = spark.range(1).select(
            ntz_literal(dt.datetime(2024, 1, 8)).alias("a"),
            ntz_literal(dt.date(2024, 1, 8)).alias("b"),
            ntz_literal("2024-01-08 10:11:12").alias("c"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.a, r.b, r.c) == (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 8, 10, 11, 12))


def test_strict_to_the_end_of_the_text(spark):
    from clickpath.functions import kv_set, parse_time, trim_comma
    from clickpath.functions.strings import id_list

    df = spark.createDataFrame([("2024-01-01 00:00:00\n", "a,\n", "a=1|b=2", " 5 ,6,+7,8\n")], "t string, c string, r string, i string")
    row = df.select(
        parse_time("t").alias("t"),
        trim_comma("c").alias("c"),
        kv_set("r", "a", F.lit(None).cast("string")).alias("r"),
        id_list("i").alias("i"),
    ).first()
    assert tuple(row) == (None, "a,\n", "a=null|b=2", [6, 7])
