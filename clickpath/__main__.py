"""Batch job: ``python -m clickpath --out DIR (--sf-dir DIR | --actions P --users P) [options]``.

Runs the four analyses and writes every output as parquet under ``--out``.
On a cluster submit it with ``spark-submit -m clickpath`` style wrappers or
call :func:`clickpath.plans.run_analyses` from a driver program; the session
(and ``spark.checkpoint.dir``) come from the submitting environment.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from clickpath.operators.filters import SessionFilter, params_range
from clickpath.plans.analyses import AnalysisParams, run_analyses
from clickpath.sources.adapter import load_actions, load_users
from clickpath.sources.tables import read_actions, read_users


def _ints(text: str | None):
    return [int(x) for x in text.split(",") if x != ""] if text else None


def _strs(text: str | None):
    return [x for x in text.split(",") if x != ""] if text else None


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="clickpath", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the benchmark tables (events, customer parquet)")
    src.add_argument("--actions", help="action log parquet in the source layout")
    p.add_argument("--users", help="user parquet in the source layout (with --actions)")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--master", help="Spark master, when not given by the environment")
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--start-age", type=int, help="default 0")
    p.add_argument("--end-age", type=int, help="default 100")
    p.add_argument("--professionals")
    p.add_argument("--cities")
    p.add_argument("--sex")
    p.add_argument("--keywords")
    p.add_argument("--category-ids")
    p.add_argument("--params", help="filter as a task parameter string, e.g. 'startAge=0|endAge=100|sex=male'")
    p.add_argument("--sample-total", type=int, default=100)
    p.add_argument("--seed", default="0")
    p.add_argument("--top-k", type=int, default=10)
    p.add_argument("--top-n", type=int, default=10)
    p.add_argument("--task-id", type=int)
    p.add_argument("--dedupe-users", action="store_true")
    args = p.parse_args(argv)
    if args.actions and not args.users:
        p.error("--actions needs --users")
    single = ("start_date", "end_date", "start_age", "end_age", "professionals", "cities", "sex", "keywords", "category_ids")
    if args.params is not None and any(getattr(args, name) is not None for name in single):
        p.error("--params holds the whole filter: give no single filter option with it")
    return args


def main(argv=None) -> dict[str, str]:
    a = parse_args(argv)
    builder = SparkSession.builder.appName("clickpath")
    if a.master:
        builder = builder.master(a.master)
    spark = builder.getOrCreate()
    if a.sf_dir:
        actions = load_actions(spark, a.sf_dir)
        users = load_users(spark, a.sf_dir)
    else:
        actions, users = read_actions(spark, a.actions), read_users(spark, a.users)
    start, end = a.start_date, a.end_date
    if a.params is not None:
        flt = SessionFilter.from_params(a.params)
        start, end = params_range(a.params)
    else:
        flt = SessionFilter(
            start_age=0 if a.start_age is None else a.start_age,
            end_age=100 if a.end_age is None else a.end_age,
            professionals=_ints(a.professionals),
            cities=_ints(a.cities),
            sex=a.sex,
            keywords=_strs(a.keywords),
            category_ids=_ints(a.category_ids),
        )
    params = AnalysisParams(
        session_filter=flt,
        sample_total=a.sample_total,
        sample_seed=a.seed,
        top_k=a.top_k,
        top_n=a.top_n,
        dedupe_users=a.dedupe_users,
        start_date=start,
        end_date=end,
    )
    written = run_analyses(spark, actions, users, a.out, params, a.task_id)
    print(json.dumps(written))
    return written


if __name__ == "__main__":
    main()
