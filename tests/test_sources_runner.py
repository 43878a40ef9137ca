from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from clickpath.plans import AnalysisParams, run_analyses
from clickpath.plans.catalog import QUERIES, SAMPLE_SEED, SAMPLE_TOTAL
from clickpath.schemas import ACTION_SCHEMA, PRODUCT_SCHEMA, RAW_ACTION_SCHEMA, USER_SCHEMA
from clickpath.sources import (
    generate_actions,
    generate_products,
    generate_users,
    load_actions,
    load_users,
    read_actions,
    read_products,
    read_users,
    write_parquet,
)
from clickpath.sources.generator import SEARCH_KEYWORDS
from tests.conftest import SF01


def test_adapter_pushes_date_range_to_scan(spark):
    df = load_actions(spark, SF01, "2024-01-08", "2024-01-21")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "value" not in plan.split("ReadSchema:")[1].split("\n")[0]


def _types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_adapter_schema(spark):
    assert _types(load_actions(spark, SF01).schema) == _types(ACTION_SCHEMA)
    assert _types(load_users(spark, SF01).schema) == _types(USER_SCHEMA)


def test_source_layout_round_trip(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            ("2018-01-03", 5, "abc", 1, "2017-05-06 07:08:09", "火锅", 3, 4, "1,2", "5", "7", "8", 9),
            ("2018-01-04", 6, "abd", 2, "2018-02-30 00:00:00", None, None, None, None, None, None, None, 1),
        ],
        RAW_ACTION_SCHEMA,
    )
    path = str(tmp_path / "actions")
    write_parquet(raw, path)
    got = read_actions(spark, path)
    assert _types(got.schema) == _types(ACTION_SCHEMA)
    rows = sorted(got.collect(), key=lambda r: r.session_id)
    assert rows[0].action_time.isoformat(sep=" ") == "2017-05-06 07:08:09"
    assert rows[1].action_time is None  # a day that does not exist is malformed, not rolled over
    assert rows[0].order_category_ids == "1,2" and rows[0].user_id == 5


def test_generator_follows_spec(spark, tmp_path):
    a, u, p = str(tmp_path / "a"), str(tmp_path / "u"), str(tmp_path / "p")
    write_parquet(generate_actions(spark, 3000, parallel=4), a)
    write_parquet(generate_users(spark, 500, parallel=2), u)
    write_parquet(generate_products(spark, 50, parallel=2), p)
    acts, users, prods = read_actions(spark, a), read_users(spark, u), read_products(spark, p)
    assert acts.count() == 3000 and users.count() == 500 and prods.count() == 50
    assert _types(users.schema) == _types(USER_SCHEMA) and _types(prods.schema) == _types(PRODUCT_SCHEMA)
    s = acts.agg(
        F.min("date"), F.max("date"), F.count_if(F.col("action_time").isNull()), F.max("click_category_id"),
        F.min(F.length("session_id")), F.max("page_id"),
    ).first()
    assert s[0] >= "2018-01-03" and s[1] <= "2018-02-03" and s[2] == 0 and s[3] <= 100 and s[4] == 3 and s[5] <= 10
    kws = {r[0] for r in acts.select("search_keyword").distinct().collect()}
    assert kws <= set(SEARCH_KEYWORDS)
    # same seed, same table
    again = generate_actions(spark, 3000, parallel=4).agg(F.sum(F.xxhash64(*RAW_ACTION_SCHEMA.names) % 1000003)).first()[0]
    first = spark.read.parquet(a).agg(F.sum(F.xxhash64(*RAW_ACTION_SCHEMA.names) % 1000003)).first()[0]
    assert again == first


def test_run_analyses_on_generated_tables(spark, tmp_path):
    a, u = str(tmp_path / "a"), str(tmp_path / "u")
    write_parquet(generate_actions(spark, 20000, parallel=4), a)
    write_parquet(generate_users(spark, 20000, parallel=4), u)
    out = run_analyses(spark, read_actions(spark, a), read_users(spark, u), str(tmp_path / "out"), task_id=1)
    assert set(out) == {
        "session_random_extract",
        "session_random_extract_detail",
        "session_aggr_stat",
        "session_aggr_stat_filtered",
        "top_categories",
        "top_sessions",
        "top_session_details",
    }
    top = spark.read.parquet(out["top_categories"])
    assert top.count() == 10 and "task_id" in top.columns
    ranked = spark.read.parquet(out["top_sessions"])
    assert ranked.groupBy("category_id").count().agg(F.max("count")).first()[0] <= 10
    stat = spark.read.parquet(out["session_aggr_stat"]).first()
    assert stat.session_count > 0


def _set(df, cols=None):
    cols = cols or sorted(df.columns)
    return {tuple(r) for r in df.select(*cols).collect()}


def test_run_analyses_matches_registered_queries(spark, tmp_path):
    params = AnalysisParams(sample_total=SAMPLE_TOTAL, sample_seed=SAMPLE_SEED)
    out = run_analyses(spark, load_actions(spark, SF01), load_users(spark, SF01), str(tmp_path / "out"), params)
    rd = spark.read.parquet
    assert _set(rd(out["top_categories"])) == _set(QUERIES["top_categories"](spark, SF01))
    assert _set(rd(out["top_sessions"])) == _set(QUERIES["top_sessions"](spark, SF01))
    assert rd(out["top_session_details"]).count() == QUERIES["top_session_details"](spark, SF01).count()
    assert _set(rd(out["session_aggr_stat"])) == _set(QUERIES["aggr_stat_all"](spark, SF01))
    cols = ["session_id", "start_time", "search_keywords", "click_category_ids"]
    got = _set(rd(out["session_random_extract"]), cols)
    want = _set(QUERIES["sample_sessions"](spark, SF01), cols)
    assert got == want and len(want) > 0
    assert rd(out["session_random_extract_detail"]).count() == QUERIES["sample_details"](spark, SF01).count()


def test_cli_runs_batch_job(spark, tmp_path):
    from clickpath.__main__ import main

    out = str(tmp_path / "cli")
    written = main(
        ["--sf-dir", SF01, "--out", out, "--start-date", "2024-01-05", "--end-date", "2024-01-20",
         "--sex", "female", "--sample-total", "2000", "--seed", "1", "--top-n", "3", "--task-id", "7"]
    )
    top = spark.read.parquet(written["top_sessions"])
    assert top.count() > 0 and top.agg(F.max("rank")).first()[0] <= 3
    assert {r.task_id for r in top.select("task_id").distinct().collect()} == {7}
    manifest = {r.output: r.path for r in spark.read.parquet(f"{out}/_manifest").collect()}
    assert manifest == written
    rows = spark.read.parquet(written["top_session_details"])
    days = {r[0][:10] for r in rows.select("action_time").distinct().collect()}
    assert min(days) >= "2024-01-05" and max(days) <= "2024-01-20"


def test_run_analyses_on_empty_tables(spark, tmp_path):
    acts = spark.createDataFrame([], ACTION_SCHEMA)
    users = spark.createDataFrame([], USER_SCHEMA)
    out = run_analyses(spark, acts, users, str(tmp_path / "out"))
    rd = spark.read.parquet
    stat = rd(out["session_aggr_stat"]).collect()
    assert len(stat) == 1 and stat[0].session_count == 0
    assert all(v is None for k, v in stat[0].asDict().items() if k.endswith("_ratio"))
    for name in ("session_random_extract", "session_random_extract_detail", "top_categories", "top_sessions", "top_session_details"):
        assert rd(out[name]).count() == 0, name


def test_date_partitioned_log_prunes_partitions(spark, tmp_path):
    from clickpath.operators import action_range

    path = str(tmp_path / "by_date")
    write_parquet(generate_actions(spark, 2000, parallel=2), path, partition_by=["date"])
    df = action_range(read_actions(spark, path), "2018-01-10", "2018-01-12")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2018-01-10" in plan
    assert {r.date for r in df.select("date").distinct().collect()} <= {"2018-01-10", "2018-01-11", "2018-01-12"}


def test_readme_example_and_cli_params(spark, tmp_path):
    from clickpath.__main__ import main
    from clickpath.operators import SessionFilter

    # the README example, on generated source-layout tables
    a, u = str(tmp_path / "a"), str(tmp_path / "u")
    write_parquet(generate_actions(spark, 5000, parallel=2), a)
    write_parquet(generate_users(spark, 2000, parallel=2), u)
    params = AnalysisParams(
        session_filter=SessionFilter.from_params("startAge=0|endAge=100"),
        sample_total=100, sample_seed="0", top_k=10, top_n=10,
        start_date="2018-01-03", end_date="2018-02-03",
    )
    written = run_analyses(spark, read_actions(spark, a), read_users(spark, u), str(tmp_path / "o1"), params, task_id=1)
    assert spark.read.parquet(written["top_categories"]).count() == 10
    # the same filter through the command line
    cli = main(["--actions", a, "--users", u, "--out", str(tmp_path / "o2"), "--params",
                "startAge=0|endAge=100|startDate=2018-01-03|endDate=2018-02-03", "--task-id", "1"])
    with pytest.raises(SystemExit):
        main(["--sf-dir", "x", "--out", "y", "--params", "sex=male", "--sex", "male"])
    for name in ("top_categories", "session_aggr_stat"):
        assert _set(spark.read.parquet(cli[name])) == _set(spark.read.parquet(written[name]))


def test_run_analyses_with_set_filters(spark, tmp_path):
    from clickpath.operators import SessionFilter, aggr_stat, apply_filter
    from clickpath.plans.catalog import _full

    flt = SessionFilter(start_age=5, end_age=55, keywords=["kw1", "kw3", "kw5"], category_ids=list(range(0, 100, 2)))
    out = run_analyses(spark, load_actions(spark, SF01), load_users(spark, SF01), str(tmp_path / "o"), AnalysisParams(session_filter=flt))
    got = _set(spark.read.parquet(out["session_aggr_stat_filtered"]))
    want = _set(aggr_stat(apply_filter(_full(spark, SF01), flt)))
    assert got == want
    assert spark.read.parquet(out["session_aggr_stat_filtered"]).first().session_count > 0


def test_run_folder_is_removed_also_on_failure(spark, tmp_path):
    from clickpath.session import checkpoint_dir

    def left():
        root = checkpoint_dir(spark).removeprefix("file://").removeprefix("file:")
        return {n for n in os.listdir(root) if n.startswith("clickpath-")}

    before = left()
    acts = spark.createDataFrame([], ACTION_SCHEMA)
    run_analyses(spark, acts, spark.createDataFrame([], USER_SCHEMA), str(tmp_path / "ok"))
    broken = spark.createDataFrame([], "user_id long")
    with pytest.raises(Exception, match="age"):
        run_analyses(spark, acts, broken, str(tmp_path / "bad"))
    assert left() == before and not (tmp_path / "bad" / "_manifest").exists()


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    import clickpath.session as session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):  # noqa: N802 - Spark's name
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
