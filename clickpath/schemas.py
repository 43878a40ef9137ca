"""Table schemas and the fixed names of the statistics buckets."""

from __future__ import annotations

from pyspark.sql import types as T

# --- source layout of the visit log as written by the table spec -------------
# Times and dates are text there; list columns hold comma-separated ids.
RAW_ACTION_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.IntegerType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.IntegerType()),
        T.StructField("click_product_id", T.IntegerType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.IntegerType()),
    ]
)

RAW_USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.IntegerType()),
        T.StructField("city", T.IntegerType()),
        T.StructField("sex", T.StringType()),
    ]
)

RAW_PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

# --- canonical in-engine layout ----------------------------------------------
# Ids widen to 64 bits (no overflow at scale), the action time is a
# timestamp_ntz truncated to whole seconds, the date stays `yyyy-MM-dd` text so a
# range filter on it reaches the parquet scan of text-dated sources.
ACTION_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)
ACTION_COLUMNS = [f.name for f in ACTION_SCHEMA.fields]

USER_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("professional", T.LongType()),
        T.StructField("city", T.LongType()),
        T.StructField("sex", T.StringType()),
    ]
)
USER_COLUMNS = [f.name for f in USER_SCHEMA.fields]

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)
PRODUCT_COLUMNS = [f.name for f in PRODUCT_SCHEMA.fields]

# Formats of the text times and dates.
DATE_KEY_FORMAT = "yyyyMMdd"

# --- fixed values: statistics buckets ------------------------------------------
# Names and bounds of the session-length buckets of the distribution report.
# Each entry is (name, lowest value inclusive, highest value inclusive or None).
# Visit length in whole seconds; a length of 0 falls in no bucket.
VISIT_LENGTH_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step length = number of actions in the session.
STEP_LENGTH_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]


def visit_ratio_column(bucket: str) -> str:
    return f"visit_length_{bucket}_ratio"


def step_ratio_column(bucket: str) -> str:
    return f"step_length_{bucket}_ratio"


AGGR_STAT_COLUMNS = (
    ["session_count"]
    + [visit_ratio_column(b) for b, _, _ in VISIT_LENGTH_BUCKETS]
    + [step_ratio_column(b) for b, _, _ in STEP_LENGTH_BUCKETS]
)

# Columns of the per-action detail record (ids of the list columns stay text).
DETAIL_COLUMNS = [
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]
