"""Registered queries: one per operator, each over the whole benchmark tables.

Every query takes ``(spark, sf_dir)``, derives the visit log from ``events``
(and users from ``customer``, products from ``part``) and returns a
DataFrame. ``plans.oracle`` holds the equivalent DuckDB SQL under the same
name and with the same output columns.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.functions import (
    after,
    before,
    date_hour,
    date_hour_text,
    format_date,
    format_date_key,
    format_double,
    format_time,
    format_time_minute,
    is_empty,
    is_not_empty,
    kv_get,
    kv_set,
    minus,
    pad_two,
    parse_date_key,
    parse_time,
    today,
    trim_comma,
    yesterday,
)
from clickpath.operators import (
    COUNT_COLUMNS,
    DEFAULT_FILTER,
    SessionFilter,
    action_range,
    aggr_stat,
    aggregate_sessions,
    apply_filter,
    apply_filter_by_actions,
    attach_lists,
    attach_users,
    apply_filter_by_flags,
    detail_record,
    hit_flags,
    hour_counts,
    hour_quotas,
    item_category_ids,
    item_counts,
    item_counts_by_joins,
    item_session_clicks,
    length_histogram,
    params_range,
    rank_categories,
    render_sessions,
    sample_details,
    session_category_counts,
    session_counters,
    session_kind_counts,
    top_item_sessions,
    top_session_details,
    weighted_details,
    weighted_items,
)
from clickpath.operators.sessions import SESSION_COLUMNS, USER_ATTRIBUTES
from clickpath.operators.hotkeys import attach_users_salted
from clickpath.operators.incremental import total_counters, update_from
from clickpath.operators.threshold import threshold_sample
from clickpath.operators.topn import salt_buckets_of
from clickpath.schemas import ACTION_COLUMNS
from clickpath.session import checkpoint_dir, cut_lineage, remove_folder
from clickpath.sources.adapter import load_actions, load_products, load_users
from clickpath.sources.layout import actions_on_days, bucketed_details, write_bucketed, write_by_day

QueryFn = Callable[[SparkSession, str], DataFrame]

# --- parameters of the registered queries ------------------------------------
RANGE_START, RANGE_END = "2024-01-08", "2024-01-21"
FILTERS = {
    "filter_age": SessionFilter(start_age=20, end_age=40),
    "filter_professional": SessionFilter(professionals=[3, 17, 42, 77]),
    "filter_city": SessionFilter(cities=[0, 5, 10, 15, 20]),
    "filter_sex": SessionFilter(sex="female"),
    "filter_keywords": SessionFilter(keywords=["kw1", "kw7"]),
    "filter_categories": SessionFilter(category_ids=[5, 25, 50]),
    "filter_all": SessionFilter(
        start_age=10, end_age=50, sex="male", keywords=["kw2", "kw3", "kw4", "kw5"], category_ids=list(range(0, 100, 3))
    ),
}
PARAMS = "startDate=2024-01-08|endDate=2024-01-21|startAge=10|endAge=50|sex=male|keywords=kw2,kw3,kw4,kw5"
STAT_FILTER = SessionFilter(start_age=10, end_age=50, sex="female")
SAMPLE_TOTAL = 3000
SAMPLE_SEED = "7"
TOP_K = 10
TOP_N = 10
SCALED_VISIT_DIVISOR = 30
PIVOT_TIME = " 12:00:00"
PERIOD_DAYS, IDLE_DAYS = 7, 2

# Field names of the reference's ``k=v|k=v`` session record (fixed values).
RECORD_FIELDS = [
    ("sessionid", "session_id"),
    ("searchKeywords", "search_keywords"),
    ("clickCategoryIds", "click_category_ids"),
    ("visitLength", "visit_length"),
    ("stepLength", "step_length"),
    ("startTime", "start_time"),
    ("age", "age"),
    ("professional", "professional"),
    ("city", "city"),
    ("sex", "sex"),
]


class _Tables:
    """The tables of one query, each opened once and derived lazily."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    @cached_property
    def actions(self) -> DataFrame:
        return load_actions(self.spark, self.d)

    @cached_property
    def users(self) -> DataFrame:
        return load_users(self.spark, self.d)

    @cached_property
    def sessions(self) -> DataFrame:
        return aggregate_sessions(self.actions)

    @cached_property
    def full(self) -> DataFrame:
        return attach_users(self.sessions, self.users)

    @cached_property
    def lean(self) -> DataFrame:
        """:attr:`full` without the set columns: a fixed-width hash aggregate."""
        return attach_users(aggregate_sessions(self.actions, with_lists=False), self.users)

    @cached_property
    def written(self) -> DataFrame:
        """:attr:`lean`, computed once."""
        return cut_lineage(self.lean)

    @cached_property
    def details(self) -> DataFrame:
        """Actions of the sessions passing the default filter, weighted by ``copies``."""
        return weighted_details(apply_filter(self.lean, DEFAULT_FILTER), self.actions)

    @cached_property
    def items(self) -> DataFrame:
        """Counts per (session, category) of the sessions passing the default filter."""
        return weighted_items(apply_filter(self.lean, DEFAULT_FILTER), session_category_counts(self.actions))


    @cached_property
    def written_items(self) -> DataFrame:
        """:attr:`items`, computed once: one row per (session, category)."""
        return cut_lineage(self.items)

    def kind_counts(self, column: str) -> DataFrame:
        """Counts of one kind per category, from the rows of that kind only."""
        listed = apply_filter(self.lean, DEFAULT_FILTER)
        return item_counts(weighted_items(listed, session_kind_counts(self.actions, column)), column)


def _actions(spark, d, start=None, end=None):
    return load_actions(spark, d, start, end)


def _sessions(spark, d):
    return _Tables(spark, d).sessions


def _full(spark, d):
    return _Tables(spark, d).full


def _lean(spark, d):
    return _Tables(spark, d).lean


def _details(spark, d):
    return _Tables(spark, d).details


def _items(spark, d):
    return _Tables(spark, d).items


def _render_actions(df: DataFrame) -> DataFrame:
    return df.select(*[format_time(c).alias(c) if c == "action_time" else F.col(c) for c in ACTION_COLUMNS])


def _record(full: DataFrame) -> DataFrame:
    """Sessions encoded as ``k=v|k=v`` text records."""
    r = render_sessions(full)
    parts = [F.concat(F.lit(name + "="), F.col(col).cast("string")) for name, col in RECORD_FIELDS]
    return r.select("session_id", "visit_length", F.concat_ws("|", *parts).alias("record"))


# --- scans and sources ---------------------------------------------------------
def q_actions(spark, d):
    return _render_actions(_actions(spark, d))


def q_action_range(spark, d):
    return _render_actions(action_range(_actions(spark, d, RANGE_START, RANGE_END), RANGE_START, RANGE_END))


def q_action_days(spark, d):
    """Actions of the days with more purchases than the average day: days from a table prune a log in day folders."""
    t = _Tables(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/clickpath-days-{uuid.uuid4().hex}"
    try:
        log = write_by_day(t.actions, path)
        per_day = log.groupBy("date").agg(F.count("pay_category_ids").alias("n"))
        days = per_day.where(F.col("n") > per_day.select(F.avg("n")).scalar())
        return cut_lineage(_render_actions(actions_on_days(log, days)))
    finally:
        remove_folder(spark, path)


def q_users(spark, d):
    return load_users(spark, d)


def q_products(spark, d):
    return load_products(spark, d)


# --- sessions and filters -------------------------------------------------------
def q_session_agg(spark, d):
    return render_sessions(_sessions(spark, d))


def q_session_full(spark, d):
    return render_sessions(_full(spark, d))


def repeated_users(users: DataFrame) -> DataFrame:
    """The user table with a second, older row for every third user."""
    return users.unionByName(users.where("user_id % 3 = 0").withColumn("age", F.col("age") + 1))


def q_session_full_deduped(spark, d):
    t = _Tables(spark, d)
    sessions = cut_lineage(aggregate_sessions(t.actions, with_lists=False))
    return render_sessions(attach_users_salted(sessions, repeated_users(t.users)))


def _filtered(spark, d, flt: SessionFilter) -> DataFrame:
    """One pass over the log decides (flags in the session aggregate); the sets are
    built for the passing sessions only."""
    t = _Tables(spark, d)
    flagged = attach_users(aggregate_sessions(t.actions, False, hit_flags(flt)), t.users)
    return render_sessions(attach_lists(apply_filter_by_flags(flagged, flt), t.actions).select(*SESSION_COLUMNS, *USER_ATTRIBUTES))


def _filter_query(name: str) -> QueryFn:
    def run(spark, d):
        return _filtered(spark, d, FILTERS[name])

    run.__name__ = f"q_{name}"
    return run


def q_filter_all_semi(spark, d):
    """``filter_all`` the way the batch job filters: sessions aggregated without
    their sets, keyword/category conditions as semi joins with the actions, sets
    attached to the passing sessions afterwards."""
    t = _Tables(spark, d)
    lean = attach_users(aggregate_sessions(t.actions, with_lists=False), t.users)
    passing = apply_filter_by_actions(lean, t.actions, FILTERS["filter_all"])
    return render_sessions(attach_lists(passing, t.actions).select(*SESSION_COLUMNS, *USER_ATTRIBUTES))


def q_filter_params(spark, d):
    """Filter and date range read from a task parameter string."""
    t = _Tables(spark, d)
    flt, (start, end) = SessionFilter.from_params(PARAMS), params_range(PARAMS)
    actions = action_range(t.actions, start, end)
    flagged = attach_users(aggregate_sessions(actions, False, hit_flags(flt)), t.users)
    return render_sessions(apply_filter_by_flags(flagged, flt))


# --- statistics -------------------------------------------------------------------
def q_visit_length_hist(spark, d):
    return length_histogram(_lean(spark, d), "visit")


def q_visit_length_hist_scaled(spark, d):
    v = F.floor(F.col("visit_length") / SCALED_VISIT_DIVISOR)
    return length_histogram(_lean(spark, d), "visit", v)


def q_step_length_hist(spark, d):
    return length_histogram(_lean(spark, d), "step")


def q_step_length_hist_by_user(spark, d):
    t = _Tables(spark, d)
    by_user = t.actions.withColumn("session_id", F.col("user_id").cast("string"))
    return length_histogram(attach_users(aggregate_sessions(by_user), t.users), "step")


def q_aggr_stat_all(spark, d):
    return aggr_stat(_lean(spark, d))


def q_aggr_stat_filtered(spark, d):
    return aggr_stat(apply_filter(_lean(spark, d), STAT_FILTER))


def q_session_counters(spark, d):
    return session_counters(_lean(spark, d))


def q_incremental_counters(spark, d):
    """Counters of the users' sessions, kept week by week: the log is replayed period by period."""
    t = _Tables(spark, d)
    actions = t.actions.withColumn("session_id", F.col("user_id").cast("string"))
    first, last = actions.agg(F.min("action_time"), F.max("action_time")).first()
    if first is None:
        return session_counters(attach_users(aggregate_sessions(actions, with_lists=False), t.users))
    edges = [dt.datetime.combine(first.date(), dt.time())]
    while edges[-1] <= last:
        edges.append(edges[-1] + dt.timedelta(days=PERIOD_DAYS))
    state = f"{checkpoint_dir(spark).rstrip('/')}/clickpath-counters-{uuid.uuid4().hex}"
    try:
        update_from(spark, state, actions, t.users, edges, idle=dt.timedelta(days=IDLE_DAYS))
        return cut_lineage(total_counters(spark, state, t.users, edges[:-1]))
    finally:
        remove_folder(spark, state)


# --- sampling ---------------------------------------------------------------------
def q_hour_counts(spark, d):
    return hour_counts(_lean(spark, d))


def q_sample_quota(spark, d):
    return hour_quotas(hour_counts(_lean(spark, d)), SAMPLE_TOTAL)


def _sample(spark, d):
    t = _Tables(spark, d)
    drawn = threshold_sample(t.written, SAMPLE_TOTAL, SAMPLE_SEED)
    return attach_lists(drawn, t.actions, max_broadcast_rows=SAMPLE_TOTAL)


def q_sample_sessions(spark, d):
    s = render_sessions(_sample(spark, d))
    return s.select("session_id", "user_id", "start_time", "search_keywords", "click_category_ids", "date", "hour", "draw_rank")


def q_sample_details(spark, d):
    t = _Tables(spark, d)
    return detail_record(sample_details(threshold_sample(t.written, SAMPLE_TOTAL, SAMPLE_SEED), t.actions, SAMPLE_TOTAL))


# --- details, categories, active sessions -------------------------------------------
def q_session_details(spark, d):
    t = _Tables(spark, d)
    return detail_record(t.details)


def q_session_details_bucketed(spark, d):
    """``session_details`` from tables bucketed by session."""
    t = _Tables(spark, d)
    names = [f"clickpath_{kind}_{uuid.uuid4().hex}" for kind in ("actions", "sessions")]
    try:
        log = write_bucketed(t.actions, names[0], salt_buckets_of(t.actions))
        listed = write_bucketed(apply_filter(t.lean, DEFAULT_FILTER), names[1], salt_buckets_of(t.actions))
        return cut_lineage(detail_record(bucketed_details(listed, log)))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def q_category_ids(spark, d):
    return item_category_ids(_items(spark, d))


def q_click_counts(spark, d):
    return _Tables(spark, d).kind_counts("click_count")


def q_order_counts(spark, d):
    return _Tables(spark, d).kind_counts("order_count")


def q_pay_counts(spark, d):
    return _Tables(spark, d).kind_counts("pay_count")


def q_category_counts(spark, d):
    return item_counts(_items(spark, d), *COUNT_COLUMNS)


def q_category_counts_joined(spark, d):
    return item_counts_by_joins(_Tables(spark, d).written_items)


def q_top_categories(spark, d):
    return rank_categories(item_counts(_items(spark, d), *COUNT_COLUMNS), TOP_K)


def q_category_session_clicks(spark, d):
    return item_session_clicks(_items(spark, d))


def q_top_sessions(spark, d):
    items = _Tables(spark, d).written_items
    return top_item_sessions(items, rank_categories(item_counts(items, *COUNT_COLUMNS), TOP_K), TOP_N, TOP_K)


def q_top_session_details(spark, d):
    t = _Tables(spark, d)
    hot = rank_categories(item_counts(t.written_items, *COUNT_COLUMNS), TOP_K)
    ranked = top_item_sessions(t.written_items, hot, TOP_N, TOP_K, keep_copies=True)
    # ranked sessions carry their copies: their rows come from the action log directly
    return detail_record(top_session_details(ranked, t.actions, TOP_N, TOP_K), "category_id")


# --- scalar helpers, each over a whole table -------------------------------------------
def q_kv_get(spark, d):
    r = _record(_full(spark, d))
    return r.select(
        "session_id",
        kv_get("record", "visitLength").alias("visit_length_text"),
        kv_get("record", "searchKeywords").alias("keywords_text"),
        kv_get("record", "startTime").alias("start_text"),
        kv_get("record", "sex").alias("sex_text"),
        kv_get("record", "noSuchField").alias("missing_text"),
    )


def q_kv_set(spark, d):
    r = _record(_full(spark, d))
    return r.select(
        "session_id",
        kv_set("record", "visitLength", (F.col("visit_length") * 2).cast("string")).alias("doubled"),
        kv_set("record", "noSuchField", F.lit("x")).alias("unchanged"),
    )


def q_trim_comma(spark, d):
    a = _actions(spark, d)
    return a.select(
        "session_id",
        format_time("action_time").alias("action_time"),
        trim_comma("order_category_ids").alias("order_trimmed"),
        trim_comma(F.concat(F.lit(","), F.col("order_category_ids"), F.lit(","))).alias("wrapped_trimmed"),
        trim_comma(F.concat(F.col("pay_category_ids"), F.lit(","))).alias("pay_trimmed"),
    )


def q_pad_two(spark, d):
    a = _actions(spark, d)
    return (
        a.select(
            pad_two(F.hour("action_time").cast("string")).alias("hour_text"),
            pad_two(F.col("page_id").cast("string")).alias("page_text"),
        )
        .groupBy("hour_text", "page_text")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_string_empty(spark, d):
    a = _actions(spark, d)
    return (
        a.select(
            is_empty("search_keyword").alias("keyword_empty"),
            is_not_empty("search_keyword").alias("keyword_present"),
            is_empty("order_category_ids").alias("order_empty"),
        )
        .groupBy("keyword_empty", "keyword_present", "order_empty")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_time_compare(spark, d):
    a = _actions(spark, d)
    at = format_time("action_time")
    pivot = F.concat(F.col("date"), F.lit(PIVOT_TIME))
    return (
        a.select(
            before(at, pivot).alias("is_before"),
            after(at, pivot).alias("is_after"),
            before(F.col("search_keyword"), at).alias("bad_before"),
        )
        .groupBy("is_before", "is_after", "bad_before")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_time_minus(spark, d):
    r = render_sessions(_full(spark, d))
    return r.select(
        "session_id",
        "visit_length",
        minus("end_time", "start_time").alias("minus_forward"),
        minus("start_time", "end_time").alias("minus_backward"),
        minus("search_keywords", "start_time").alias("minus_bad"),
    )


def q_date_keys(spark, d):
    s = _lean(spark, d)
    key = format_date_key("start_time")
    return s.select(
        "session_id",
        format_date("start_time").alias("start_date"),
        format_time("start_time").alias("start_text"),
        key.alias("date_key"),
        parse_date_key(key).alias("parsed_date"),
        parse_date_key(F.col("session_id")).alias("bad_date"),
        format_time_minute("start_time").alias("time_minute"),
        date_hour("start_time").alias("date_hour"),
        date_hour_text(format_time("start_time")).alias("date_hour_text"),
    )


def q_parse_times(spark, d):
    a = _actions(spark, d)
    at = format_time("action_time")
    return (
        a.select(
            F.coalesce(parse_time(at) == F.col("action_time"), F.lit(False)).alias("round_trip"),
            parse_time(F.col("date")).isNull().alias("date_only_null"),
            parse_time(F.concat(F.col("date"), F.lit(" 25:00:00"))).isNull().alias("bad_hour_null"),
        )
        .groupBy("round_trip", "date_only_null", "bad_hour_null")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def q_format_double(spark, d):
    ev = spark.read.parquet(f"{d.rstrip('/')}/events.parquet").select("event_id", "value")
    return ev.select(
        "event_id",
        "value",
        format_double("value", 1).alias("value_1dp"),
        format_double(F.col("value") / 8, 2).alias("eighth_2dp"),
        format_double(-F.col("value"), 1).alias("negated_1dp"),
        format_double("value", 0).alias("value_0dp"),
    )


def q_relative_dates(spark, d):
    s = _lean(spark, d)
    return s.select(
        "session_id",
        today().alias("today"),
        yesterday().alias("yesterday"),
        F.datediff(today(), yesterday()).cast("long").alias("gap"),
        F.datediff(today(), F.to_date("start_time")).cast("long").alias("days_ago"),
    )


QUERIES: dict[str, QueryFn] = {
    "actions": q_actions,
    "action_range": q_action_range,
    "action_days": q_action_days,
    "users": q_users,
    "products": q_products,
    "session_agg": q_session_agg,
    "session_full": q_session_full,
    "session_full_deduped": q_session_full_deduped,
    **{name: _filter_query(name) for name in FILTERS},
    "filter_all_semi": q_filter_all_semi,
    "filter_params": q_filter_params,
    "visit_length_hist": q_visit_length_hist,
    "visit_length_hist_scaled": q_visit_length_hist_scaled,
    "step_length_hist": q_step_length_hist,
    "step_length_hist_by_user": q_step_length_hist_by_user,
    "aggr_stat_all": q_aggr_stat_all,
    "aggr_stat_filtered": q_aggr_stat_filtered,
    "session_counters": q_session_counters,
    "incremental_counters": q_incremental_counters,
    "hour_counts": q_hour_counts,
    "sample_quota": q_sample_quota,
    "sample_sessions": q_sample_sessions,
    "sample_details": q_sample_details,
    "session_details": q_session_details,
    "session_details_bucketed": q_session_details_bucketed,
    "category_ids": q_category_ids,
    "click_counts": q_click_counts,
    "order_counts": q_order_counts,
    "pay_counts": q_pay_counts,
    "category_counts": q_category_counts,
    "category_counts_joined": q_category_counts_joined,
    "top_categories": q_top_categories,
    "category_session_clicks": q_category_session_clicks,
    "top_sessions": q_top_sessions,
    "top_session_details": q_top_session_details,
    "kv_get": q_kv_get,
    "kv_set": q_kv_set,
    "trim_comma": q_trim_comma,
    "pad_two": q_pad_two,
    "string_empty": q_string_empty,
    "time_compare": q_time_compare,
    "time_minus": q_time_minus,
    "date_keys": q_date_keys,
    "parse_times": q_parse_times,
    "format_double": q_format_double,
    "relative_dates": q_relative_dates,
}
