"""Time the full batch job (P1–P4) on a generated visit log.

Usage: python scripts/bench_synthetic.py OUT_DIR [ACTION_ROWS] [USER_ROWS] [CPUS]

Generates the action and user tables with the table-spec generator into
OUT_DIR (parquet), then runs ``run_analyses`` on them and prints one JSON
line with the generation time, the job time and the settings used.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpath.plans import AnalysisParams, run_analyses  # noqa: E402
from clickpath.session import build_session  # noqa: E402
from clickpath.sources import generate_actions, generate_users, read_actions, read_users, write_parquet  # noqa: E402


def main() -> None:
    out = sys.argv[1].rstrip("/")
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 10_000_000
    users = int(sys.argv[3]) if len(sys.argv) > 3 else 1_000_000
    cpus = int(sys.argv[4]) if len(sys.argv) > 4 else 8
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus * 4,
        app_name="clickpath-synthetic",
        extra={"spark.checkpoint.dir": f"{out}/checkpoints"},
    )

    t0 = time.perf_counter()
    write_parquet(generate_actions(spark, rows, parallel=max(10, cpus * 2)), f"{out}/actions")
    write_parquet(generate_users(spark, users, parallel=10), f"{out}/users")
    gen = time.perf_counter() - t0

    t1 = time.perf_counter()
    written = run_analyses(
        spark,
        read_actions(spark, f"{out}/actions"),
        read_users(spark, f"{out}/users"),
        f"{out}/result",
        AnalysisParams(),
        task_id=1,
    )
    job = time.perf_counter() - t1
    counts = {k: spark.read.parquet(v).count() for k, v in written.items()}
    print(
        json.dumps(
            {
                "action_rows": rows,
                "user_rows": users,
                "cpus": cpus,
                "shuffle_partitions": cpus * 4,
                "driver_memory": spark.conf.get("spark.driver.memory", "?"),
                "generate_sec": round(gen, 2),
                "job_sec": round(job, 2),
                "output_rows": counts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
