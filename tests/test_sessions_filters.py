from __future__ import annotations

import pytest

from clickpath.operators import (
    params_range,
    SessionFilter,
    action_range,
    aggregate_sessions,
    apply_filter,
    attach_users,
    full_sessions,
    render_sessions,
    session_details,
)
from tests.conftest import action, make_actions, make_users, ts, user


def _by_id(df, key="session_id"):
    return {r[key]: r for r in df.collect()}


def test_session_aggregate_basics(spark):
    rows = [
        action("s1", 7, "2024-01-01 10:00:05", keyword="火锅", click=3),
        action("s1", 7, "2024-01-01 10:00:00", keyword="蛋糕"),
        action("s1", 7, "2024-01-01 10:01:00", keyword="火锅", click=1),
        action("s1", 7, "2024-01-01 10:00:30", keyword="", click=3),
        action("s1", 7, "2024-01-01 10:00:40", keyword=None),
        action("s2", 8, "2024-01-02 00:00:00"),
    ]
    s = _by_id(aggregate_sessions(make_actions(spark, rows)))
    a = s["s1"]
    assert a.user_id == 7 and a.step_length == 5 and a.visit_length == 60
    assert a.start_time == ts("2024-01-01 10:00:00") and a.end_time == ts("2024-01-01 10:01:00")
    assert a.keywords == sorted(["火锅", "蛋糕"]) and a.click_categories == [1, 3]
    b = s["s2"]
    assert b.visit_length == 0 and b.step_length == 1 and b.keywords == [] and b.click_categories == []
    r = _by_id(render_sessions(aggregate_sessions(make_actions(spark, rows))))
    assert r["s1"].search_keywords == ",".join(sorted(["火锅", "蛋糕"])) and r["s1"].click_category_ids == "1,3"
    assert r["s1"].start_time == "2024-01-01 10:00:00"


def test_first_user_is_earliest_then_smallest(spark):
    rows = [
        action("s", 9, "2024-01-01 10:00:00"),
        action("s", 4, "2024-01-01 10:00:00"),
        action("s", 1, "2024-01-01 10:00:01"),
        action("t", 5, "2024-01-01 09:00:00"),
        action("t", 2, "2024-01-01 09:30:00"),
    ]
    s = _by_id(aggregate_sessions(make_actions(spark, rows)))
    assert s["s"].user_id == 4 and s["t"].user_id == 5


def test_unknown_user_drops_and_duplicate_user_multiplies(spark):
    acts = make_actions(spark, [action("a", 1), action("b", 2), action("c", 3)])
    users = make_users(spark, [user(1, age=20), user(2, age=30), user(2, age=31)])
    full = full_sessions(acts, users)
    got = sorted((r.session_id, r.age) for r in full.collect())
    assert got == [("a", 20), ("b", 30), ("b", 31)]
    deduped = sorted((r.session_id, r.age) for r in full_sessions(acts, users, dedupe=True).collect())
    assert deduped == [("a", 20), ("b", 30)]
    # details follow the session rows: a duplicated session yields its actions twice
    assert session_details(full, acts).count() == 3


def test_action_range_inclusive(spark):
    rows = [action(time=f"2024-01-0{d} 12:00:00") for d in range(1, 6)]
    df = action_range(make_actions(spark, rows), "2024-01-02", "2024-01-04")
    assert sorted(r.date for r in df.collect()) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    assert action_range(make_actions(spark, rows)).count() == 5


def _sessions(spark):
    acts = make_actions(
        spark,
        [
            action("a", 1, keyword="kw1", click=5),
            action("b", 2, keyword="kw2", click=6),
            action("c", 3),
            action("d", 4, keyword="kw1"),
        ],
    )
    users = make_users(
        spark,
        [
            user(1, age=20, professional=10, city=1, sex="male"),
            user(2, age=40, professional=20, city=2, sex="female"),
            user(3, age=None, professional=None, city=None, sex=None),
            user(4, age=60, professional=10, city=3, sex="female"),
        ],
    )
    return attach_users(aggregate_sessions(acts), users)


def _ids(df):
    return sorted(r.session_id for r in df.collect())


def test_filter_parameters(spark):
    s = _sessions(spark)
    assert _ids(apply_filter(s, SessionFilter())) == ["a", "b", "c", "d"]
    assert _ids(apply_filter(s, SessionFilter(start_age=20, end_age=40))) == ["a", "b"]
    # only one bound: the age condition does not apply
    assert _ids(apply_filter(s, SessionFilter(start_age=50))) == ["a", "b", "c", "d"]
    assert _ids(apply_filter(s, SessionFilter(professionals=[10]))) == ["a", "d"]
    assert _ids(apply_filter(s, SessionFilter(professionals=[]))) == ["a", "b", "c", "d"]
    assert _ids(apply_filter(s, SessionFilter(cities=[2, 3, 99]))) == ["b", "d"]
    assert _ids(apply_filter(s, SessionFilter(sex="female"))) == ["b", "d"]
    assert _ids(apply_filter(s, SessionFilter(keywords=["kw1"]))) == ["a", "d"]
    assert _ids(apply_filter(s, SessionFilter(keywords=["nope"]))) == []
    assert _ids(apply_filter(s, SessionFilter(category_ids=[6, 7]))) == ["b"]
    both = SessionFilter(start_age=0, end_age=100, sex="female", keywords=["kw1", "kw2"])
    assert _ids(apply_filter(s, both)) == ["b", "d"]


def test_filter_predicates_stay_in_codegen(spark):
    s = _sessions(spark)
    plan = apply_filter(s, SessionFilter(keywords=["kw1"], cities=[1]))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_render_keeps_non_ascii(spark):
    acts = make_actions(spark, [action("z", 1, keyword="温泉"), action("z", 1, keyword="日本料理")])
    r = render_sessions(aggregate_sessions(acts)).first()
    assert r.search_keywords.split(",") == sorted(["温泉", "日本料理"])


def test_filter_by_actions_equals_set_filter(spark):
    from clickpath.operators import apply_filter_by_actions, attach_lists, render_sessions
    from clickpath.plans.catalog import FILTERS, _actions, _full
    from clickpath.sources.adapter import load_users
    from tests.conftest import SF01

    acts = _actions(spark, SF01)
    with_sets = _full(spark, SF01)
    without = attach_users(aggregate_sessions(acts, with_lists=False), load_users(spark, SF01))
    assert "keywords" not in without.columns
    for name, flt in FILTERS.items():
        a = {r.session_id for r in apply_filter(with_sets, flt).select("session_id").collect()}
        b = {r.session_id for r in apply_filter_by_actions(without, acts, flt).select("session_id").collect()}
        assert a == b, name
    # sets attached afterwards equal the sets aggregated with the session
    some = without.where("user_id % 7 = 0")
    got = {r.session_id: (r.search_keywords, r.click_category_ids) for r in render_sessions(attach_lists(some, acts)).collect()}
    want = {r.session_id: (r.search_keywords, r.click_category_ids) for r in render_sessions(with_sets.where("user_id % 7 = 0")).collect()}
    assert got == want and len(got) > 0


def test_filter_parameter_string_round_trip():
    f = SessionFilter.from_params("startAge=0|endAge=100|")
    assert f == SessionFilter(start_age=0, end_age=100)
    g = SessionFilter.from_params("startAge=10|endAge=50|professionals=1,2|cities=3|sex=female|keywords=火锅,温泉|categoryIds=5,6")
    assert g == SessionFilter(10, 50, [1, 2], [3], "female", ["火锅", "温泉"], [5, 6])
    assert SessionFilter.from_params(g.to_params()) == g
    # empty values, repeated names and unknown names
    h = SessionFilter.from_params("sex=|sex=male|professionals=|startDate=2024-01-01|cities=1==2|endAge=9")
    assert h == SessionFilter(end_age=9, sex="male")
    with pytest.raises(ValueError, match="foo"):
        SessionFilter.from_params("sex=male|foo=1")
    assert params_range("startDate=2024-01-01|endDate=2024-01-31|sex=male") == ("2024-01-01", "2024-01-31")
    assert SessionFilter.from_params(None) == SessionFilter() and SessionFilter().to_params() == ""


def test_first_user_mixed_key_paths(spark):
    big = 2**40  # beyond the 29-bit packed key: takes the decimal path
    rows = [
        # whole seconds, small ids: packed key
        action("p", 9, "2024-01-01 10:00:00"),
        action("p", 4, "2024-01-01 10:00:00"),
        # a big id tied with a small one at the earliest second: the smaller id wins
        action("q", big, "2024-01-01 10:00:00"),
        action("q", 7, "2024-01-01 10:00:00"),
        action("q", 3, "2024-01-01 10:00:05"),
        # a big id strictly earlier than every small id
        action("r", big + 1, "2024-01-01 09:59:59"),
        action("r", 2, "2024-01-01 10:00:00"),
        # pre-1970 time (decimal path) earlier than a packed one
        action("s", 5, "1969-12-31 23:59:59"),
        action("s", 1, "2024-01-01 00:00:00"),
        # negative id only
        action("t", -3, "2024-01-01 00:00:00"),
    ]
    df = make_actions(spark, rows)
    # sub-second times (decimal path) order before the whole second they fall in
    frac = spark.createDataFrame(
        [("u", 8, ts("2024-01-01 10:00:00.5")), ("u", 6, ts("2024-01-01 10:00:01")), ("v", 6, ts("2024-01-01 10:00:00.5")), ("v", 8, ts("2024-01-01 10:00:00"))],
        "session_id string, user_id long, action_time timestamp_ntz",
    )
    full = df.unionByName(frac, allowMissingColumns=True)
    got = {r.session_id: r.user_id for r in aggregate_sessions(full, with_lists=False).collect()}
    assert got == {"p": 4, "q": 7, "r": big + 1, "s": 5, "t": -3, "u": 8, "v": 8}


def test_dedupe_hot_user_split_equals_plain_dedupe_join(spark):
    import random

    from clickpath.operators import dedupe_users

    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        sid = f"s{i % 1500}"
        uid = 7 if i % 1500 < 600 else rnd.randint(100, 2000)  # user 7 holds 40% of the sessions
        rows.append(action(sid, uid if i < 1500 else None, "2024-01-01 10:00:00"))
    acts = make_actions(spark, rows)
    users = make_users(spark, [user(7, age=a) for a in (50, 40, 45)] + [user(u, age=u % 60) for u in range(100, 2001) for _ in range(2)])
    sessions = aggregate_sessions(acts, with_lists=False)
    got = sorted(tuple(r) for r in attach_users(sessions, users, dedupe=True).collect())
    plain = sessions.join(dedupe_users(users).select("user_id", "age", "professional", "city", "sex"), "user_id")
    want = sorted(tuple(r) for r in plain.select(*sessions.columns, "age", "professional", "city", "sex").collect())
    assert got == want and len(got) == 1500
    assert {r[0] for r in got if r[1] == 7} and all(r[-4] == 40 for r in got if r[1] == 7)
