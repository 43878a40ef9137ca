"""Run the batch job twice, once with injected task failures; print both results.

Used by tests/test_retry.py in its own process (master local[4,4]: up to four
attempts per task). The failure injection is a test-only filter on the input.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickpath.plans import AnalysisParams, run_analyses  # noqa: E402
from clickpath.session import build_session  # noqa: E402
from clickpath.sources.adapter import load_actions, load_users  # noqa: E402


def _flaky_keep(_x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


def result(spark, written):
    out = {}
    for name, path in sorted(written.items()):
        rows = spark.read.parquet(path).collect()
        out[name] = sorted(json.dumps(r.asDict(), sort_keys=True, default=str) for r in rows)
    return out


def main() -> None:
    sf_dir = sys.argv[1]
    spark = build_session(master="local[4,4]", shuffle_partitions=4)
    params = AnalysisParams(sample_total=3000, sample_seed="7")
    users = load_users(spark, sf_dir)
    clean = run_analyses(spark, load_actions(spark, sf_dir), users, tempfile.mkdtemp(prefix="retry-clean-"), params)
    flaky_keep = F.udf(_flaky_keep, "boolean")
    flaky_actions = load_actions(spark, sf_dir).where(flaky_keep(F.col("session_id")))
    flaky = run_analyses(spark, flaky_actions, users, tempfile.mkdtemp(prefix="retry-flaky-"), params)
    print(json.dumps({"clean": result(spark, clean), "flaky": result(spark, flaky)}))
    spark.stop()


if __name__ == "__main__":
    main()
