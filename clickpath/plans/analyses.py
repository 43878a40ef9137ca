"""The four analyses composed end to end, and a batch runner writing their outputs.

P1  session aggregation, user enrichment, filter, length distribution
P2  random sample proportional to traffic per day and hour, with detail rows
P3  top-k hot categories by clicks, orders and payments
P4  top-n active sessions of each hot category, with detail rows

``run_analyses`` is the batch job. It reads the action log four times: the
session aggregate (with the filter's flags), the counts per session and
category, the rows of the sampled and the rows of the ranked sessions (both
small broadcast sides). Intermediates that several outputs read (sessions,
sample, items, ranked sessions) are written as Parquet in a folder of the run
under ``spark.checkpoint.dir``, which cuts their lineage, and the folder
is removed at the end, also on failure. No step copies the action log. A
manifest of the outputs is written last.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.operators.active import top_item_sessions, top_session_details
from clickpath.operators.categories import COUNT_COLUMNS, item_counts, rank_categories, session_category_counts, weighted_items
from clickpath.operators.filters import (
    DEFAULT_FILTER,
    SessionFilter,
    action_range,
    apply_filter_by_flags,
    hit_flags,
    params_range,
)
from clickpath.operators.sampling import DEFAULT_SEED, DEFAULT_TOTAL, sample_details
from clickpath.operators.sessions import LIST_COLUMNS, aggregate_sessions, attach_lists, attach_users, detail_record, render_sessions
from clickpath.operators.stats import aggr_stat
from clickpath.operators.threshold import threshold_sample
from clickpath.session import checkpoint_dir, describe_jobs, remove_folder
from clickpath.sources.sinks import write_parquet


@dataclass(frozen=True)
class AnalysisParams:
    session_filter: SessionFilter = field(default_factory=lambda: DEFAULT_FILTER)
    sample_total: int = DEFAULT_TOTAL
    sample_seed: str = DEFAULT_SEED
    top_k: int = 10
    top_n: int = 10
    dedupe_users: bool = False
    start_date: str | None = None  # inclusive action date range, yyyy-MM-dd
    end_date: str | None = None

    @classmethod
    def from_params(cls, text: str | None, **others) -> "AnalysisParams":
        """The filter and the date range of a task parameter string."""
        start, end = params_range(text)
        return cls(session_filter=SessionFilter.from_params(text), start_date=start, end_date=end, **others)


def _materialize(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    write_parquet(df, folder)
    return spark.read.parquet(folder)


def run_analyses(
    spark: SparkSession,
    actions: DataFrame,
    users: DataFrame,
    out_dir: str,
    params: AnalysisParams = AnalysisParams(),
    task_id: int | None = None,
    concurrent: bool = True,
) -> dict[str, str]:
    """Run P1–P4 and write every output as parquet under ``out_dir``.

    Returns output name → folder. ``task_id``, when given, is added as a
    column to every output, as the analysed job tagged its records.

    After the shared session table is written, the statistics, the sample and
    the category chain run side by side. With
    ``concurrent`` independent chains are submitted from separate driver
    threads, which Spark schedules as concurrent jobs sharing the executors;
    only job submission happens on those threads, no data passes through them.
    """
    run_id = uuid.uuid4().hex
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/clickpath-{run_id}"
    try:
        written = _run_analyses(spark, actions, users, out_dir, params, task_id, concurrent, scratch)
        # the completion mark comes last: outputs without this run's manifest are not whole
        manifest = [(run_id, name, path) for name, path in sorted(written.items())]
        write_parquet(spark.createDataFrame(manifest, "run string, output string, path string").coalesce(1), f"{out_dir.rstrip('/')}/_manifest")
    finally:
        remove_folder(spark, scratch)
    return written


def _run_analyses(spark, actions, users, out_dir, params, task_id, concurrent, scratch) -> dict[str, str]:
    actions = action_range(actions, params.start_date, params.end_date)
    out = out_dir.rstrip("/")
    written: dict[str, str] = {}

    def emit(name: str, df: DataFrame) -> None:
        if task_id is not None:
            df = df.select(F.lit(task_id).alias("task_id"), *df.columns)
        path = f"{out}/{name}"
        describe_jobs(spark, f"clickpath: {name}")
        write_parquet(df, path)
        written[name] = path

    # sessions without their keyword / category sets: fixed-width aggregate whose
    # flags decide the filter; sets are built for sampled sessions only
    describe_jobs(spark, "clickpath: sessions")
    flags = hit_flags(params.session_filter)
    if params.dedupe_users:
        # the hot-user split reads the session table several times: aggregate once
        raw = _materialize(spark, aggregate_sessions(actions, False, flags), f"{scratch}/raw_sessions")
        sessions = _materialize(spark, attach_users(raw, users, dedupe=True), f"{scratch}/sessions")
    else:
        sessions = _materialize(spark, attach_users(aggregate_sessions(actions, False, flags), users), f"{scratch}/sessions")
    filtered = apply_filter_by_flags(sessions, params.session_filter)

    def stats_chain() -> None:
        emit("session_aggr_stat", aggr_stat(sessions))
        emit("session_aggr_stat_filtered", aggr_stat(filtered))

    def sample_chain() -> None:
        total = params.sample_total
        # the sample is at most `total` rows: written once
        describe_jobs(spark, "clickpath: sample")
        sample = _materialize(spark, threshold_sample(sessions.drop(*flags), total, params.sample_seed), f"{scratch}/sample")
        rows = _materialize(spark, sample_details(sample, actions, total), f"{scratch}/sample_rows")
        emit("session_random_extract_detail", detail_record(rows))
        # keyword / category sets of the sampled sessions from their own rows
        picked = attach_lists(sample.select("session_id", "start_time"), rows, max_broadcast_rows=total)
        emit("session_random_extract", render_sessions(picked.select("session_id", "start_time", *LIST_COLUMNS)))

    def category_chain() -> None:
        # one row per (session, category) instead of a copy of the action log
        describe_jobs(spark, "clickpath: items")
        items = _materialize(spark, weighted_items(filtered, session_category_counts(actions)), f"{scratch}/items")
        describe_jobs(spark, "clickpath: top categories")
        hot = rank_categories(item_counts(items, *COUNT_COLUMNS), params.top_k)
        hot = _materialize(spark, hot, f"{scratch}/top_categories")
        emit("top_categories", hot)
        ranked = top_item_sessions(items, hot, params.top_n, params.top_k, keep_copies=True)
        ranked = _materialize(spark, ranked, f"{scratch}/ranked")
        emit("top_sessions", ranked.drop("copies"))
        rows = top_session_details(ranked, actions, params.top_n, params.top_k)
        emit("top_session_details", detail_record(rows, "category_id"))

    _run([category_chain, sample_chain, stats_chain], concurrent)
    return written


def _run(steps, concurrent: bool) -> None:
    """Run independent job chains, from separate driver threads when ``concurrent``."""
    if not concurrent:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(max_workers=len(steps), thread_name_prefix="clickpath") as pool:
        for future in [pool.submit(step) for step in steps]:
            future.result()  # re-raises the first failure
