"""Synthetic tables following the declarative table spec of the analysed job.

Rows come from ``spark.range`` split into ``parallel`` partitions and every
column is a seeded function of the row id, so a table of any size is
generated in parallel on the executors and is the same on every run.
Used to produce large benchmark inputs; no registered query depends on it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions.dates import format_time, ntz_literal

# --- fixed values of the table spec --------------------------------------------
SEARCH_KEYWORDS = ["火锅", "蛋糕", "重庆辣子鸡", "重庆小面", "呷哺呷哺", "新辣道鱼火锅", "国贸大厦", "太古商场", "日本料理", "温泉"]
SEXES = ["male", "female"]
EXTEND_INFOS = ["1", "2"]
ACTION_DATE_RANGE = ("2018-01-03", "2018-02-03")
ACTION_TIME_RANGE = ("2016-02-03 00:00:00", "2018-02-03 00:00:00")
USER_ID_MAX = 100000
AGE_MAX = 60
SMALL_ID_MAX = 100  # categories, products, professions, cities
PAGE_ID_MAX = 10
SESSION_ID_LENGTH = 3
NAME_LENGTH = 4
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"


def _uniform_int(seed: int, lo: int, hi: int) -> Column:
    """Integer uniform on [lo, hi] from a seeded per-row random stream."""
    return (F.floor(F.rand(seed) * (hi - lo + 1)) + lo).cast("int")


def _pick(seed: int, values: list[str]) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, _uniform_int(seed, 1, len(values)))


def _random_text(seed: int, length: int) -> Column:
    chars = [F.substring(F.lit(ALPHABET), _uniform_int(seed * 31 + i, 1, len(ALPHABET)), 1) for i in range(length)]
    return F.concat(*chars)


def _rows(spark: SparkSession, rows: int, parallel: int) -> DataFrame:
    return spark.range(0, rows, 1, numPartitions=parallel)


def generate_actions(spark: SparkSession, rows: int, parallel: int = 10, seed: int = 42) -> DataFrame:
    """Visit-log rows in the source layout (``schemas.RAW_ACTION_SCHEMA``)."""
    d0 = _dt.date.fromisoformat(ACTION_DATE_RANGE[0])
    d1 = _dt.date.fromisoformat(ACTION_DATE_RANGE[1])
    t0 = _dt.datetime.fromisoformat(ACTION_TIME_RANGE[0])
    t1 = _dt.datetime.fromisoformat(ACTION_TIME_RANGE[1])
    span_s = int((t1 - t0).total_seconds())
    date = F.date_add(F.lit(d0), _uniform_int(seed + 1, 0, (d1 - d0).days))
    time = ntz_literal(t0) + F.make_dt_interval(secs=_uniform_int(seed + 2, 0, span_s))
    s = seed * 100
    return _rows(spark, rows, parallel).select(
        date.cast("string").alias("date"),  # zone-free text of a date
        _uniform_int(s + 3, 0, USER_ID_MAX).alias("user_id"),
        _random_text(s + 4, SESSION_ID_LENGTH).alias("session_id"),
        _uniform_int(s + 5, 0, PAGE_ID_MAX).alias("page_id"),
        format_time(time).alias("action_time"),
        _pick(s + 6, SEARCH_KEYWORDS).alias("search_keyword"),
        _uniform_int(s + 7, 0, SMALL_ID_MAX).alias("click_category_id"),
        _uniform_int(s + 8, 0, SMALL_ID_MAX).alias("click_product_id"),
        _uniform_int(s + 9, 0, SMALL_ID_MAX).cast("string").alias("order_category_ids"),
        _uniform_int(s + 10, 0, SMALL_ID_MAX).cast("string").alias("order_product_ids"),
        _uniform_int(s + 11, 0, SMALL_ID_MAX).cast("string").alias("pay_category_ids"),
        _uniform_int(s + 12, 0, SMALL_ID_MAX).cast("string").alias("pay_product_ids"),
        _uniform_int(s + 13, 0, SMALL_ID_MAX).alias("city_id"),
    )


def generate_users(spark: SparkSession, rows: int, parallel: int = 10, seed: int = 43) -> DataFrame:
    """User rows in the source layout; ids repeat, as in the spec."""
    s = seed * 100
    return _rows(spark, rows, parallel).select(
        _uniform_int(s + 1, 0, USER_ID_MAX).alias("user_id"),
        _random_text(s + 2, NAME_LENGTH).alias("user_name"),
        _random_text(s + 3, NAME_LENGTH).alias("name"),
        _uniform_int(s + 4, 0, AGE_MAX).alias("age"),
        _uniform_int(s + 5, 0, SMALL_ID_MAX).alias("professional"),
        _uniform_int(s + 6, 0, SMALL_ID_MAX).alias("city"),
        _pick(s + 7, SEXES).alias("sex"),
    )


def generate_products(spark: SparkSession, rows: int, parallel: int = 10, seed: int = 44) -> DataFrame:
    s = seed * 100
    return _rows(spark, rows, parallel).select(
        _uniform_int(s + 1, 0, SMALL_ID_MAX).alias("product_id"),
        _random_text(s + 2, NAME_LENGTH).alias("product_name"),
        _pick(s + 3, EXTEND_INFOS).alias("extend_info"),
    )
