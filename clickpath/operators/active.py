"""Most active sessions of each hot category, and their detail rows.

Plan shape: the hot categories are a top-k result, at most ``k`` rows, so
they are broadcast into a left-semi join that drops every other click
before anything is shuffled. Clicks per (category, session) are a hash
aggregate with a map-side partial step. The per-category ranking is
``topn.ranked_top`` in a salted two-phase
rank, so a hot category never lands whole in one task. The detail
join takes the ranked sessions (at most ``k * n`` rows) as its broadcast side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.operators.categories import CLICK, category_actions
from clickpath.operators.filters import non_null
from clickpath.operators.sessions import BROADCAST_ROWS, weight
from clickpath.operators.topn import ranked_top


def category_session_clicks(details: DataFrame) -> DataFrame:
    """``(category_id, session_id, click_count)`` for every clicked category."""
    return (
        non_null(details, "click_category_id")
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.sum(weight(details)).alias("click_count"))
    )


def top_sessions(
    details: DataFrame,
    hot: DataFrame,
    n: int = 10,
    k: int = 10,
    salt_buckets: int | None = None,
    keep_copies: bool = False,
    share_items: bool = True,
) -> DataFrame:
    """Per hot category the ``n`` sessions with most clicks (ties: smaller session id).

    ``hot`` holds ``category_id`` and at most ``k`` rows (a top-k result).
    ``keep_copies`` keeps the ``copies`` weight of weighted details on each
    ranked row, so :func:`top_session_details` can read the raw actions.

    ``share_items``: read the clicks from the same exploded (category, kind)
    items as the category counts. When ``details`` is a plan that derives
    from the action log, both branches are then identical up to the explode
    and Spark reuses their shuffles (the action log is shuffled once). When
    ``details`` is a written table there is nothing to share and a plain
    filter on the click column is cheaper: pass ``False``.
    """
    hot_ids = hot.select("category_id")
    if k <= BROADCAST_ROWS:
        hot_ids = F.broadcast(hot_ids)
    if share_items:
        clicks = category_actions(details).where(F.col("kind") == CLICK)
    else:
        clicks = non_null(details, "click_category_id").select(
            "session_id", weight(details).alias("copies"), F.col("click_category_id").alias("category_id")
        )
    hot_clicks = clicks.join(hot_ids, "category_id", "left_semi")
    counts = hot_clicks.groupBy("category_id", "session_id").agg(
        F.sum("copies").alias("click_count"),
        F.max("copies").alias("copies"),  # the same on every row of a session
    )
    ranked = ranked_top(
        counts,
        by=["category_id"],
        order=[F.col("click_count").desc(), F.col("session_id").asc()],
        max_rank=n,
        rank_col="rank",
        salt_key="session_id",
        salt_buckets=salt_buckets,
    )
    cols = ["category_id", "session_id", "click_count", "rank"]
    if keep_copies and "copies" in details.columns:
        cols.append("copies")
    return ranked.select(*cols)


def item_session_clicks(items: DataFrame) -> DataFrame:
    """``(category_id, session_id, click_count)`` of ``categories.weighted_items``."""
    return items.where(F.col("click_count") > 0).select(
        "category_id", "session_id", (F.col("click_count") * F.col("copies")).alias("click_count")
    )


def top_item_sessions(items: DataFrame, hot: DataFrame, n: int = 10, k: int = 10, keep_copies: bool = False) -> DataFrame:
    """:func:`top_sessions` from ``categories.weighted_items``: the items are one row per
    (session, category) already, so only the ranking shuffles."""
    hot_ids = hot.select("category_id")
    if k <= BROADCAST_ROWS:
        hot_ids = F.broadcast(hot_ids)
    clicks = items.where(F.col("click_count") > 0).join(hot_ids, "category_id", "left_semi")
    clicks = clicks.select("category_id", "session_id", (F.col("click_count") * F.col("copies")).alias("click_count"), "copies")
    ranked = ranked_top(
        clicks,
        by=["category_id"],
        order=[F.col("click_count").desc(), F.col("session_id").asc()],
        max_rank=n,
        rank_col="rank",
        salt_key="session_id",
    )
    cols = ["category_id", "session_id", "click_count", "rank"]
    return ranked.select(*cols, *(["copies"] if keep_copies else []))


def top_session_details(ranked: DataFrame, source: DataFrame, n: int = 10, k: int = 10) -> DataFrame:
    """Detail rows of every ranked session, tagged with its category.

    ``source`` is either the (weighted) details the ranking came from, or
    the raw action log when ``ranked`` carries ``copies`` (``keep_copies``):
    ranked sessions passed the filter already, so their actions need no
    second pass through the session filter and the user join, only a scan
    joined with the broadcast ranked side.
    A session ranked in several categories yields its rows once per category;
    ``detail_record`` expands the ``copies`` weight into repeated rows.
    """
    keep = ["category_id", "session_id"]
    if "copies" in ranked.columns and "copies" not in source.columns:
        keep.append("copies")
    side = ranked.select(*keep)
    if k * n <= BROADCAST_ROWS:
        side = F.broadcast(side)
    return source.join(side, "session_id", "inner")
