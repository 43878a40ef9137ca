"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best run kept, after one untimed warm-up pass),
BENCH_QUERIES (comma list, optional).
Each query runs to completion through the ``noop`` sink (all rows are
produced, nothing is collected on the driver). ``batch_job_sec`` is the
whole batch job (P1–P4, every output written as parquet to a scratch
folder) on the same tables; it is reported beside the headline total.
BENCH_BATCH=0 skips it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickpath.plans import AnalysisParams, run_analyses  # noqa: E402
from clickpath.plans.catalog import QUERIES  # noqa: E402
from clickpath.session import build_session  # noqa: E402
from clickpath.sources.adapter import load_actions, load_users  # noqa: E402

HEADLINE = [
    "session_full",  # P1: per-session aggregate + user join
    "aggr_stat_all",  # P1: length distribution of all sessions
    "aggr_stat_filtered",  # P1: distribution after the filter
    "sample_sessions",  # P2: proportional sample
    "sample_details",  # P2: sample detail rows
    "top_categories",  # P3: hot categories
    "top_sessions",  # P4: active sessions per hot category
    "top_session_details",  # P4: their detail rows
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="clickpath-bench")

    # warm-up pass, not timed: JVM class loading, JIT and codegen caches, so
    # every query is measured in the same steady state
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    medians: dict[str, float] = {}
    for name in names:
        took = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[name], medians[name] = round(min(took), 3), round(median(took), 3)

    batch = None
    if os.environ.get("BENCH_BATCH", "1") != "0":
        out = tempfile.mkdtemp(prefix="clickpath-bench-")
        t0 = time.perf_counter()
        run_analyses(spark, load_actions(spark, sf_dir), load_users(spark, sf_dir), out, AnalysisParams(sample_total=3000))
        batch = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "medians": medians,
                "sf": sf,
                "cpus": cpus,
                "batch_job_sec": batch,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
