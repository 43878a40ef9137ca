"""Hot categories: clicks, orders and payments per category, and the top k.

Detail tables may carry a ``copies`` weight (see
``sessions.weighted_details``); every count is then a sum of weights.

One pass: every action is exploded into its (category, kind) items and a
single hash aggregate keyed by category counts the three kinds with a
map-side partial step, so only one row per category per task is shuffled,
however skewed the categories are. The separate per-kind counts and the
three-left-join combination are kept as operators of their own (they are
what the one-pass form replaces, and tests check both agree).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.functions.strings import parse_id
from clickpath.operators.filters import non_null
from clickpath.operators.sessions import weight

CLICK, ORDER, PAY = "click", "order", "pay"


def category_actions(details: DataFrame) -> DataFrame:
    """One row per (action, category, kind); malformed or missing ids are skipped.

    The click id and the split order / pay lists are concatenated as text and
    ``posexplode``-d once; the kind follows from the position. No lambda
    functions (they run outside whole-stage codegen): about 4x cheaper per
    row than transforming each list.
    """
    empty = F.array().cast("array<string>")
    click = F.when(F.col("click_category_id").isNotNull(), F.array(F.col("click_category_id").cast("string"))).otherwise(
        empty
    )
    orders = F.coalesce(F.split("order_category_ids", ","), empty)
    pays = F.coalesce(F.split("pay_category_ids", ","), empty)
    items = details.select(
        "session_id",
        weight(details).alias("copies"),
        F.size(click).alias("_nc"),
        F.size(orders).alias("_no"),
        F.posexplode(F.concat(click, orders, pays)).alias("_pos", "_id"),
    )
    pos = F.col("_pos")
    kind = (
        F.when(pos < F.col("_nc"), F.lit(CLICK))
        .when(pos < F.col("_nc") + F.col("_no"), F.lit(ORDER))
        .otherwise(F.lit(PAY))
    )
    return items.select(
        "session_id", "copies", parse_id("_id").alias("category_id"), kind.alias("kind")
    ).where(F.col("category_id").isNotNull())


def category_ids(details: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid."""
    return category_actions(details).select("category_id").distinct()


def click_counts(details: DataFrame) -> DataFrame:
    return (
        non_null(details, "click_category_id")
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.sum(weight(details)).alias("click_count"))
    )


def _list_counts(details: DataFrame, column: str, out: str) -> DataFrame:
    ids = non_null(details, column).select(weight(details).alias("copies"), F.explode(F.split(column, ",")).alias("_id"))
    return (
        ids.select("copies", parse_id("_id").alias("category_id"))
        .where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.sum("copies").alias(out))
    )


def order_counts(details: DataFrame) -> DataFrame:
    return _list_counts(details, "order_category_ids", "order_count")


def pay_counts(details: DataFrame) -> DataFrame:
    return _list_counts(details, "pay_category_ids", "pay_count")


def category_counts(details: DataFrame) -> DataFrame:
    """``(category_id, click_count, order_count, pay_count)`` in one aggregation."""
    kind, w, zero = F.col("kind"), F.col("copies"), F.lit(0).cast("long")
    return (
        category_actions(details)
        .groupBy("category_id")
        .agg(
            F.sum(F.when(kind == CLICK, w).otherwise(zero)).alias("click_count"),
            F.sum(F.when(kind == ORDER, w).otherwise(zero)).alias("order_count"),
            F.sum(F.when(kind == PAY, w).otherwise(zero)).alias("pay_count"),
        )
    )


def session_category_counts(actions: DataFrame) -> DataFrame:
    """``(session_id, category_id, click_count, order_count, pay_count)`` of the raw log.

    One hash aggregate with a map-side partial step, before any session join:
    a session shrinks to one row per distinct category in every map task, so
    no later count joins or shuffles raw actions by ``session_id``.
    """
    kind, zero = F.col("kind"), F.lit(0).cast("long")
    count = lambda k, name: F.sum(F.when(kind == k, F.lit(1).cast("long")).otherwise(zero)).alias(name)
    return (
        category_actions(actions.drop("copies"))
        .groupBy("session_id", "category_id")
        .agg(count(CLICK, "click_count"), count(ORDER, "order_count"), count(PAY, "pay_count"))
    )


COUNT_COLUMNS = ["click_count", "order_count", "pay_count"]


def session_kind_counts(actions: DataFrame, column: str) -> DataFrame:
    """``(session_id, category_id, <column>)`` of the raw log for one of ``COUNT_COLUMNS``: only the rows and
    the id list of that kind are read."""
    if column == "click_count":
        ids = non_null(actions, "click_category_id").select("session_id", F.col("click_category_id").alias("category_id"))
    else:
        source = {"order_count": "order_category_ids", "pay_count": "pay_category_ids"}[column]
        ids = non_null(actions, source).select("session_id", F.explode(F.split(source, ",")).alias("_id"))
        ids = ids.select("session_id", parse_id("_id").alias("category_id")).where(F.col("category_id").isNotNull())
    return ids.groupBy("session_id", "category_id").agg(F.count(F.lit(1)).alias(column))


def weighted_items(sessions: DataFrame, counts: DataFrame) -> DataFrame:
    """:func:`session_category_counts` of the given sessions, with ``copies`` = how often
    the session is listed (counts are per listing).

    Both join inputs are small: one row per listed session, and one row per
    (session, category). The counts are shuffled by session once more, so the
    join has plain shuffles and a hot session is at most one row per category.
    """
    key = ["session_id", "user_id"] if "user_id" in sessions.columns else ["session_id"]
    copies = sessions.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).select("session_id", "copies")
    return counts.join(copies, "session_id", "inner")


def item_category_ids(items: DataFrame) -> DataFrame:
    """Distinct categories of :func:`weighted_items`."""
    return items.select("category_id").distinct()


def item_counts(items: DataFrame, *columns: str) -> DataFrame:
    """Counts per category of :func:`weighted_items`; for a single kind, only its categories."""
    rows = items.where(F.col(columns[0]) > 0) if len(columns) == 1 else items
    return rows.groupBy("category_id").agg(*[F.sum(F.col(c) * F.col("copies")).alias(c) for c in columns])


def item_counts_by_joins(items: DataFrame) -> DataFrame:
    """The same counts as distinct categories left-joined with each kind's counts."""
    out = item_category_ids(items)
    for name in COUNT_COLUMNS:
        out = out.join(item_counts(items, name), "category_id", "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))
    return out.select("category_id", *COUNT_COLUMNS)


def category_counts_by_joins(details: DataFrame) -> DataFrame:
    """The same counts as distinct categories left-joined with each per-kind count."""
    out = category_ids(details)
    for part, name in (
        (click_counts(details), "click_count"),
        (order_counts(details), "order_count"),
        (pay_counts(details), "pay_count"),
    ):
        out = out.join(part, "category_id", "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))
    return out.select("category_id", "click_count", "order_count", "pay_count")


def rank_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` by clicks, then orders, then payments (all descending), ties by id."""
    return counts.orderBy(
        F.col("click_count").desc(),
        F.col("order_count").desc(),
        F.col("pay_count").desc(),
        F.col("category_id").asc(),
    ).limit(k)


def top_categories(details: DataFrame, k: int = 10) -> DataFrame:
    return rank_categories(category_counts(details), k)
