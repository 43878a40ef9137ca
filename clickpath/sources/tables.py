"""Readers of the visit-log tables in their source layout.

The source layout (``schemas.RAW_*``) keeps times as text and ids as ints.
``normalize_*`` turns it into the canonical layout used by every operator:
64-bit ids, ``timestamp_ntz`` action times, list columns as text.
Reading with an explicit schema avoids inference jobs; selecting by name
means only the needed parquet columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions.dates import parse_time
from clickpath.schemas import (
    ACTION_COLUMNS,
    PRODUCT_COLUMNS,
    RAW_ACTION_SCHEMA,
    RAW_PRODUCT_SCHEMA,
    RAW_USER_SCHEMA,
    USER_COLUMNS,
)


def normalize_actions(raw: DataFrame) -> DataFrame:
    """Source-layout action rows → canonical action log."""
    return raw.select(
        F.col("date").cast("string").alias("date"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("session_id").cast("string").alias("session_id"),
        F.col("page_id").cast("long").alias("page_id"),
        parse_time(F.col("action_time").cast("string")).alias("action_time"),
        F.col("search_keyword").cast("string").alias("search_keyword"),
        F.col("click_category_id").cast("long").alias("click_category_id"),
        F.col("click_product_id").cast("long").alias("click_product_id"),
        # the generator writes one int here, the analyses read a comma list
        F.col("order_category_ids").cast("string").alias("order_category_ids"),
        F.col("order_product_ids").cast("string").alias("order_product_ids"),
        F.col("pay_category_ids").cast("string").alias("pay_category_ids"),
        F.col("pay_product_ids").cast("string").alias("pay_product_ids"),
        F.col("city_id").cast("long").alias("city_id"),
    ).select(*ACTION_COLUMNS)


def normalize_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("user_id").cast("long").alias("user_id"),
        F.col("user_name").cast("string").alias("user_name"),
        F.col("name").cast("string").alias("name"),
        F.col("age").cast("long").alias("age"),
        F.col("professional").cast("long").alias("professional"),
        F.col("city").cast("long").alias("city"),
        F.col("sex").cast("string").alias("sex"),
    ).select(*USER_COLUMNS)


def normalize_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_id").cast("long").alias("product_id"),
        F.col("product_name").cast("string").alias("product_name"),
        F.col("extend_info").cast("string").alias("extend_info"),
    ).select(*PRODUCT_COLUMNS)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Action log parquet (source layout) → canonical DataFrame."""
    return normalize_actions(spark.read.schema(RAW_ACTION_SCHEMA).parquet(path))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return normalize_users(spark.read.schema(RAW_USER_SCHEMA).parquet(path))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return normalize_products(spark.read.schema(RAW_PRODUCT_SCHEMA).parquet(path))
