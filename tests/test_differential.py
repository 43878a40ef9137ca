"""The batch job against a plain-Python brute force on random source-layout tables.

Random fixture: repeated and unknown user ids (session fan-out), null and
malformed category lists, empty and null keywords, many ties. The brute
force follows the rules directly, row by row, with no weighting.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import random
from collections import Counter, defaultdict

import pytest

from clickpath.plans import AnalysisParams, run_analyses
from clickpath.schemas import RAW_ACTION_SCHEMA, RAW_USER_SCHEMA, STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS
from clickpath.sources import read_actions, read_users, write_parquet

TOTAL, SEED, K, N = 40, "5", 5, 3


def _ids(text):
    if text is None:
        return []
    out = []
    for part in text.split(","):
        try:
            out.append(int(part))
        except ValueError:
            pass
    return out


def _fixture(seed: int):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 3, 1)
    actions = []
    for i in range(600):
        sid = f"s{rnd.randint(0, 60)}"
        uid = rnd.choice([1, 2, 3, 4, 5, 6, 7, 8, 99])  # 99 has no user row
        t = base + dt.timedelta(days=rnd.randint(0, 3), hours=rnd.randint(0, 5), seconds=rnd.randint(0, 4000))
        kind = rnd.random()
        click = rnd.randint(0, 12) if kind < 0.4 else None
        orders = rnd.choice(["1,2", "3", "x,4", "", "5,,6", None]) if 0.4 <= kind < 0.7 else None
        pays = rnd.choice(["2", "7,8", "bad", None]) if kind >= 0.7 else None
        kw = rnd.choice(["火锅", "温泉", "", None, "kw"])
        actions.append(("2024-03-01", uid, sid, i % 7, t.strftime("%Y-%m-%d %H:%M:%S"), kw, click, 1, orders, "1", pays, "2", 3))
    users = []
    for uid in range(1, 9):
        for _ in range(rnd.randint(1, 3)):  # repeated ids
            users.append((uid, "u", "n", rnd.randint(0, 60), rnd.randint(0, 5), rnd.randint(0, 5), rnd.choice(["male", "female"])))
    return actions, users


def _brute(actions, users):
    by_session = defaultdict(list)
    for a in actions:
        by_session[a[2]].append(a)
    sessions = []
    for sid, rows in by_session.items():
        times = [dt.datetime.fromisoformat(r[4]) for r in rows]
        start, end = min(times), max(times)
        user = min((t, r[1]) for t, r in zip(times, rows))[1]
        sessions.append({"sid": sid, "user": user, "start": start, "visit": int((end - start).total_seconds()), "steps": len(rows),
                         "kws": sorted({r[5] for r in rows if r[5]}), "cats": sorted({r[6] for r in rows if r[6] is not None})})
    full = [dict(s, age=u[3]) for s in sessions for u in users if u[0] == s["user"]]
    # statistics over all enriched session rows
    t = len(full)

    def ratio(n):
        return None if t == 0 else ((200 * n + t) // (2 * t)) / 100

    stat = {"session_count": t}
    for name, lo, hi in VISIT_LENGTH_BUCKETS:
        stat[f"visit_length_{name}_ratio"] = ratio(sum(1 for s in full if s["visit"] >= lo and (hi is None or s["visit"] <= hi)))
    for name, lo, hi in STEP_LENGTH_BUCKETS:
        stat[f"step_length_{name}_ratio"] = ratio(sum(1 for s in full if s["steps"] >= lo and (hi is None or s["steps"] <= hi)))
    # details: every filtered session row (age 0..100) times its actions
    details = [a for s in full if 0 <= s["age"] <= 100 for a in by_session[s["sid"]]]
    counts = defaultdict(lambda: [0, 0, 0])
    for a in details:
        if a[6] is not None:
            counts[a[6]][0] += 1
        for c in _ids(a[8]):
            counts[c][1] += 1
        for c in _ids(a[10]):
            counts[c][2] += 1
    top = sorted(counts.items(), key=lambda kv: (-kv[1][0], -kv[1][1], -kv[1][2], kv[0]))[:K]
    hot = {c for c, _ in top}
    clicks = Counter((a[6], a[2]) for a in details if a[6] in hot)
    ranked = {}
    for c in hot:
        per = sorted(((-n, sid) for (cc, sid), n in clicks.items() if cc == c))[:N]
        for rank, (neg, sid) in enumerate(per, 1):
            ranked[(c, sid)] = (-neg, rank)
    top_rows = Counter((c, a[2], a[4]) for (c, sid) in ranked for s in full if s["sid"] == sid and 0 <= s["age"] <= 100 for a in by_session[sid])
    # sample over all enriched session rows
    hours = defaultdict(list)
    for s in full:
        hours[(s["start"].date(), s["start"].hour)].append(s)
    days = len({d for d, _ in hours})
    per_day = Counter()
    for (d, _), rows in hours.items():
        per_day[d] += len(rows)
    sample = []
    for (d, h), rows in hours.items():
        quota = min(len(rows), (len(rows) * (TOTAL // days)) // per_day[d])
        rows = sorted(rows, key=lambda s: (hashlib.md5(f"{s['sid']}:{SEED}".encode()).hexdigest(), s["sid"]))
        sample += rows[:quota]
    sample_rows = Counter((a[2], a[4]) for s in sample for a in by_session[s["sid"]])
    return {
        "stat": stat,
        "top": {c: tuple(v) for c, v in top},
        "ranked": ranked,
        "top_rows": top_rows,
        "sample": Counter((s["sid"], ",".join(s["kws"]), ",".join(str(c) for c in s["cats"])) for s in sample),
        "sample_rows": sample_rows,
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_job_equals_brute_force(spark, tmp_path, seed):
    actions, users = _fixture(seed)
    a, u = str(tmp_path / "a"), str(tmp_path / "u")
    write_parquet(spark.createDataFrame(actions, RAW_ACTION_SCHEMA), a)
    write_parquet(spark.createDataFrame(users, RAW_USER_SCHEMA), u)
    params = AnalysisParams(sample_total=TOTAL, sample_seed=SEED, top_k=K, top_n=N)
    out = run_analyses(spark, read_actions(spark, a), read_users(spark, u), str(tmp_path / "o"), params)
    want = _brute(actions, users)
    rd = spark.read.parquet

    stat = rd(out["session_aggr_stat"]).first().asDict()
    assert stat == want["stat"]
    top = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in rd(out["top_categories"]).collect()}
    assert top == want["top"]
    ranked = {(r.category_id, r.session_id): (r.click_count, r.rank) for r in rd(out["top_sessions"]).collect()}
    assert ranked == want["ranked"]
    top_rows = Counter((r.category_id, r.session_id, r.action_time) for r in rd(out["top_session_details"]).collect())
    assert top_rows == want["top_rows"]
    sample = Counter((r.session_id, r.search_keywords, r.click_category_ids) for r in rd(out["session_random_extract"]).collect())
    assert sample == want["sample"] and sum(sample.values()) > 0
    sample_rows = Counter((r.session_id, r.action_time) for r in rd(out["session_random_extract_detail"]).collect())
    assert sample_rows == want["sample_rows"]
