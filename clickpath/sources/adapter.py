"""Adapter from the benchmark tables (``events``, ``customer``, ``part``).

The benchmark data has no visit log of its own, so one is derived, row for
row, from ``events``; ``customer`` plays the user dimension and ``part`` the
product dimension. The oracle SQL in ``plans.oracle`` derives the same
columns with the same rules.

Sessions are user-days: ``session_id = user_id || '-' || date``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions.dates import ntz_literal
from clickpath.schemas import ACTION_COLUMNS, PRODUCT_COLUMNS, USER_COLUMNS

# --- fixed values of the adapter rules ---------------------------------------
KEYWORD_PREFIX = "kw"  # view events search "kw0" … "kw9" (event_id % 10)
PRODUCT_MODULUS = 2000  # product ids = event_id % 2000
PAGE_MODULUS = 10  # page_id = event_id % 10
CITY_MODULUS = 100  # city_id = event_id % 100
SECOND_ORDER_OFFSET = 7  # signups order categories k and (k + 7) % 100
CATEGORY_MODULUS = 100
AGE_FACTOR, AGE_MODULUS = 7, 61  # age = c_custkey * 7 % 61
PROFESSIONAL_MODULUS = 100  # professional = c_custkey % 100


def _ts_bound(day: str, plus_days: int = 0):
    return ntz_literal(_dt.date.fromisoformat(day) + _dt.timedelta(days=plus_days))


def actions_from_events(
    events: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """``events`` → canonical action log.

    ``start_date`` / ``end_date`` (inclusive, ``yyyy-MM-dd``) become literal
    bounds on ``ts`` so they reach the parquet scan as pushed filters; the
    derived ``date`` column could not be pushed.
    """
    ev = events.select("event_id", "ts", "user_id", "event_type", "props")
    if start_date is not None:
        ev = ev.where(F.col("ts") >= _ts_bound(start_date))
    if end_date is not None:
        ev = ev.where(F.col("ts") < _ts_bound(end_date, plus_days=1))
    # parse the JSON once, and only for the event kinds that use `k` (its own
    # projection: `k` feeds several conditional columns below)
    ev = ev.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "CAST(to_date(ts) AS STRING) AS day",  # no zone involved for timestamp_ntz
        "CASE WHEN event_type IN ('click', 'signup', 'purchase') "
        "THEN try_cast(get_json_object(props, '$.k') AS BIGINT) END AS k",
    )
    # One SQL expression per column: a single call to declare, the same plan as
    # the equivalent Column expressions.
    return ev.selectExpr(*[f"{expr} AS {name}" for name, expr in _action_rules()])


def _action_rules() -> list[tuple[str, str]]:
    product = f"CAST(event_id % {PRODUCT_MODULUS} AS STRING)"
    seconds = "date_part('SECOND', ts)"
    rules = {
        "date": "day",
        "user_id": "CAST(user_id AS BIGINT)",
        "session_id": "concat(CAST(user_id AS STRING), '-', day)",
        "page_id": f"event_id % {PAGE_MODULUS}",
        "action_time": f"ts - make_dt_interval(0, 0, 0, {seconds} - floor({seconds}))",
        "search_keyword": f"CASE WHEN event_type = 'view' THEN concat('{KEYWORD_PREFIX}', CAST(event_id % 10 AS STRING)) END",
        "click_category_id": "CASE WHEN event_type = 'click' THEN k END",
        "click_product_id": f"CASE WHEN event_type = 'click' THEN event_id % {PRODUCT_MODULUS} END",
        "order_category_ids": "CASE WHEN event_type = 'signup' THEN concat_ws(',', CAST(k AS STRING), "
        f"CAST((k + {SECOND_ORDER_OFFSET}) % {CATEGORY_MODULUS} AS STRING)) END",
        "order_product_ids": f"CASE WHEN event_type = 'signup' THEN {product} END",
        "pay_category_ids": "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END",
        "pay_product_ids": f"CASE WHEN event_type = 'purchase' THEN {product} END",
        "city_id": f"event_id % {CITY_MODULUS}",
    }
    return [(name, rules[name]) for name in ACTION_COLUMNS]


def users_from_customer(customer: DataFrame) -> DataFrame:
    """``customer`` → user dimension (keys are unique there)."""
    key = F.col("c_custkey").cast("long")
    return customer.select(
        key.alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_name").alias("name"),
        (key * AGE_FACTOR % AGE_MODULUS).alias("age"),
        (key % PROFESSIONAL_MODULUS).alias("professional"),
        F.col("c_nationkey").cast("long").alias("city"),
        F.when(key % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    ).select(*USER_COLUMNS)


def products_from_part(part: DataFrame) -> DataFrame:
    """``part`` → product dimension; ``extend_info`` is "1" or "2" by size parity."""
    return part.select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        (F.col("p_size") % 2 + 1).cast("string").alias("extend_info"),
    ).select(*PRODUCT_COLUMNS)


# Columns the adapter reads from each benchmark table, with their parquet types.
# Declaring them skips schema inference (footer reads) when a table is opened.
INPUT_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_size int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(INPUT_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_actions(
    spark: SparkSession, sf_dir: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    return actions_from_events(_read(spark, sf_dir, "events"), start_date, end_date)


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_customer(_read(spark, sf_dir, "customer"))


def load_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_from_part(_read(spark, sf_dir, "part"))
