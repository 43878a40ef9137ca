"""Measure how the batch job spreads a hot session and a hot hour over tasks.

Usage: python scripts/skew_check.py SCRATCH_DIR [ACTION_ROWS] [GROUP_LIMIT_THRESHOLD]

With GROUP_LIMIT_THRESHOLD below the sample total (3000), the sample draw
takes the salted two-phase path instead of the partial group limit.

Generates a log where one session holds a third of all actions, a third of
all sessions start in the same hour and a third belong to one user, runs the batch job with Spark's event
log written to SCRATCH_DIR, and prints per stage the number of tasks and the
largest task's share of the stage's shuffle-read records. AQE's skew-join
thresholds are lowered to this small size so its splitting shows (on a
cluster the defaults apply to far larger partitions), and size-based
broadcasting is off so every join takes the shuffle path of large tables.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from clickpath.plans import AnalysisParams, run_analyses  # noqa: E402
from clickpath.session import build_session  # noqa: E402
from clickpath.sources import generate_actions, generate_users, read_actions, read_users, write_parquet  # noqa: E402


def skewed_actions(spark, rows: int):
    base = generate_actions(spark, rows, parallel=16).withColumn("_rid", F.monotonically_increasing_id())
    rid = F.col("_rid")
    hot_session = F.pmod(F.xxhash64(rid), F.lit(3)) == 0  # a third of the actions
    hot_hour = F.pmod(F.xxhash64(F.col("session_id")), F.lit(3)) == 0  # a third of the sessions
    session = F.concat(F.col("session_id"), F.lit("-"), (rid % 50000).cast("string"))
    hour_time = F.concat(F.lit("2017-06-01 10:"), F.lpad((rid % 60).cast("string"), 2, "0"), F.lit(":00"))
    return (
        base.withColumn("session_id", F.when(hot_session, F.lit("HOT")).otherwise(session))
        # the hot session's user, and a third of all other sessions, belong to user 7 (a hot user)
        .withColumn("user_id", F.when(hot_session | (F.pmod(F.xxhash64(F.col("session_id")), F.lit(3)) == 1), F.lit(7)).otherwise(F.col("user_id")))
        .withColumn("action_time", F.when(hot_hour & ~hot_session, hour_time).otherwise(F.col("action_time")))
        .drop("_rid")
    )


def stage_skew(log_dir: str):
    import zstandard

    path = glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "events_*"))
    stages: dict[int, dict] = {}
    for p in path:
        with open(p, "rb") as fh:
            reader = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8") if p.endswith(".zstd") else io.TextIOWrapper(fh, encoding="utf-8")
            for line in reader:
                e = json.loads(line)
                if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    m = e["Task Metrics"]
                    recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    st = stages.setdefault(e["Stage ID"], {"tasks": 0, "records": []})
                    st["tasks"] += 1
                    st["records"].append(recs)
                if e["Event"] == "SparkListenerStageSubmitted":
                    info = e["Stage Info"]
                    desc = (e.get("Properties") or {}).get("spark.job.description", "")
                    stages.setdefault(info["Stage ID"], {"tasks": 0, "records": []})["name"] = desc
    return stages


def main() -> None:
    scratch = sys.argv[1].rstrip("/")
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 3_000_000
    threshold = sys.argv[3] if len(sys.argv) > 3 else "10000"
    log_dir = f"{scratch}/eventlog"
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session(
        master="local[8]",
        shuffle_partitions=32,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
            "spark.sql.optimizer.windowGroupLimitThreshold": threshold,
            # tables as if large: no size-based broadcast, so joins take the shuffle path
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        },
    )
    write_parquet(skewed_actions(spark, rows), f"{scratch}/actions")
    write_parquet(generate_users(spark, 200_000, parallel=8), f"{scratch}/users")
    t0 = time.perf_counter()
    run_analyses(
        spark,
        read_actions(spark, f"{scratch}/actions"),
        read_users(spark, f"{scratch}/users"),
        f"{scratch}/result",
        AnalysisParams(sample_total=3000, dedupe_users=os.environ.get("SKEW_DEDUPE", "0") == "1"),
    )
    job = time.perf_counter() - t0
    spark.stop()
    report = []
    for sid, st in sorted(stage_skew(log_dir).items()):
        recs = st["records"]
        total = sum(recs)
        if total < 1000:
            continue
        report.append({"stage": sid, "name": st.get("name", ""), "tasks": st["tasks"], "shuffle_records": total, "max_task_share": round(max(recs) / total, 3)})
    print(json.dumps({"action_rows": rows, "job_sec": round(job, 1), "stages": report}))


if __name__ == "__main__":
    main()
