from __future__ import annotations

from clickpath.operators import (
    category_counts,
    category_counts_by_joins,
    category_ids,
    category_session_clicks,
    click_counts,
    order_counts,
    pay_counts,
    rank_categories,
    top_categories,
    top_session_details,
    top_sessions,
)
from tests.conftest import SF01, action, make_actions


def _details(spark):
    rows = [
        action("s1", click=1, orders="1,2"),
        action("s1", click=1, orders="", pays="2"),
        action("s1", click=2, orders=None, pays="1,,3"),
        action("s2", click=1, orders="x,3", pays=None),
        action("s2", click=None, orders="4", pays="4"),
        action("s3", click=2),
        action("s3", click=2),
        action("s3", click=None, orders=None, pays=None),
    ]
    return make_actions(spark, rows)


def _as_map(df, key="category_id"):
    return {r[key]: tuple(v for k, v in r.asDict().items() if k != key) for r in df.collect()}


def test_counts_skip_missing_and_malformed_ids(spark):
    d = _details(spark)
    assert sorted(r.category_id for r in category_ids(d).collect()) == [1, 2, 3, 4]
    assert _as_map(click_counts(d)) == {1: (3,), 2: (3,)}
    assert _as_map(order_counts(d)) == {1: (1,), 2: (1,), 3: (1,), 4: (1,)}
    assert _as_map(pay_counts(d)) == {1: (1,), 2: (1,), 3: (1,), 4: (1,)}
    assert _as_map(category_counts(d)) == {1: (3, 1, 1), 2: (3, 1, 1), 3: (0, 1, 1), 4: (0, 1, 1)}


def test_one_pass_equals_three_joins(spark):
    from clickpath.plans.catalog import _details as details

    d = details(spark, SF01)
    a = {tuple(r) for r in category_counts(d).select("category_id", "click_count", "order_count", "pay_count").collect()}
    b = {tuple(r) for r in category_counts_by_joins(d).collect()}
    assert a == b and len(a) > 0


def test_rank_order_and_tie_break(spark):
    counts = spark.createDataFrame(
        [(5, 3, 0, 0), (4, 3, 0, 0), (3, 3, 1, 0), (2, 3, 1, 1), (1, 9, 0, 0), (6, 0, 9, 9)],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    got = [r.category_id for r in rank_categories(counts, 4).collect()]
    assert got == [1, 2, 3, 4]
    assert [r.category_id for r in rank_categories(counts, 10).collect()] == [1, 2, 3, 4, 5, 6]


def test_top_sessions_ties_and_short_groups(spark):
    rows = []
    # category 1: sessions a(3 clicks) b(2) c(2) d(1); category 2: only b(1)
    for sid, n in (("a", 3), ("b", 2), ("c", 2), ("d", 1)):
        rows += [action(sid, click=1)] * n
    rows += [action("b", click=2)]
    d = make_actions(spark, rows)
    hot = top_categories(d, 10)
    ranked = top_sessions(d, hot, n=2, k=10)
    got = sorted((r.category_id, r.rank, r.session_id, r.click_count) for r in ranked.collect())
    assert got == [(1, 1, "a", 3), (1, 2, "b", 2), (2, 1, "b", 1)]
    # b is active in both categories: its 3 actions come once per category
    rows_out = top_session_details(ranked, d, n=2, k=10)
    per = sorted((r.category_id, r.session_id) for r in rows_out.collect())
    assert per.count((1, "b")) == 3 and per.count((2, "b")) == 3 and per.count((1, "a")) == 3


def test_top_sessions_property_on_table(spark):
    from clickpath.plans.catalog import _details as details

    d = details(spark, SF01)
    hot = top_categories(d, 10)
    n = 3
    ranked = {(r.category_id, r.session_id): r.click_count for r in top_sessions(d, hot, n=n).collect()}
    allc = category_session_clicks(d).collect()
    hot_ids = {r.category_id for r in hot.collect()}
    for cat in hot_ids:
        kept = [c for (k, _), c in ranked.items() if k == cat]
        dropped = [r.click_count for r in allc if r.category_id == cat and (cat, r.session_id) not in ranked]
        assert len(kept) <= n
        if dropped:
            assert min(kept) >= max(dropped)


def test_top_group_limit_is_partial_before_shuffle(spark):
    from clickpath.plans.catalog import _details as details

    d = details(spark, SF01)
    df = top_sessions(d, top_categories(d, 10), n=10)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_weighted_details_equal_materialised_fan_out(spark):
    from clickpath.operators import (
        attach_users,
        aggregate_sessions,
        detail_record,
        session_details,
        weighted_details,
    )
    from tests.conftest import make_users, user

    rows = [
        action("a", 1, click=1, orders="1,2"),
        action("a", 1, click=2, pays="3"),
        action("b", 2, click=1),
        action("b", 2, click=1),
        action("c", 3, click=2, orders="2"),
    ]
    acts = make_actions(spark, rows)
    # user 1 listed three times, user 2 twice, user 3 once
    users = make_users(spark, [user(1, age=20), user(1, age=21), user(1, age=22), user(2), user(2), user(3)])
    full = attach_users(aggregate_sessions(acts), users)
    plain, weighted = session_details(full, acts), weighted_details(full, acts)
    assert plain.count() == 3 * 2 + 2 * 2 + 1 and weighted.count() == 5

    def same(f):
        return sorted(tuple(r) for r in f(plain).collect()) == sorted(tuple(r) for r in f(weighted).collect())

    assert same(category_counts) and same(click_counts) and same(order_counts) and same(pay_counts)
    assert same(category_session_clicks) and same(lambda d: top_sessions(d, top_categories(d), n=2))
    assert same(detail_record)
    assert same(lambda d: detail_record(top_session_details(top_sessions(d, top_categories(d), n=2), d), "category_id"))


def test_top_sessions_salted_path_equals_group_limit(spark):
    from clickpath.plans.catalog import _details as details

    d = details(spark, SF01)
    hot = top_categories(d, 10)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "2")  # n above the threshold: salted two-phase rank
        salted_df = top_sessions(d, hot, n=5, salt_buckets=3)
        salted = sorted(tuple(r) for r in salted_df.collect())
        assert "_salt" in salted_df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    plain = sorted(tuple(r) for r in top_sessions(d, hot, n=5).collect())
    assert salted == plain and len(plain) == 50


def test_ranked_rows_from_actions_equal_rows_from_details(spark):
    from clickpath.operators import aggregate_sessions, attach_users, detail_record, weighted_details
    from tests.conftest import make_users, user

    rows = [action("a", 1, click=1), action("a", 1, click=1, orders="2"), action("b", 2, click=1), action("c", 3, click=2)]
    acts = make_actions(spark, rows)
    users = make_users(spark, [user(1), user(1), user(1), user(2), user(3), user(3)])
    w = weighted_details(attach_users(aggregate_sessions(acts), users), acts)
    hot = top_categories(w)
    via_details = detail_record(top_session_details(top_sessions(w, hot, n=2), w), "category_id")
    ranked = top_sessions(w, hot, n=2, keep_copies=True)
    assert "copies" in ranked.columns
    via_actions = detail_record(top_session_details(ranked, acts), "category_id")
    a = sorted((tuple(r) for r in via_details.collect()), key=repr)
    b = sorted((tuple(r) for r in via_actions.collect()), key=repr)
    assert a == b and len(a) == 3 * 2 + 1 + 2  # a: 3 copies x 2 actions; b: 1; c: 2 copies x 1
