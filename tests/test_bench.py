"""bench.py prints one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import SF001

BENCH = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "bench.py")


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_REPEAT="1", BENCH_QUERIES="session_full,top_categories")
    proc = subprocess.run([sys.executable, BENCH], capture_output=True, text=True, env=env, timeout=600, check=False)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    got = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(got)
    assert got["unit"] == "sec" and got["sf"] == 0.001
    assert set(got["queries"]) == {"session_full", "top_categories"}
    assert abs(got["value"] - sum(got["queries"].values())) < 0.01
    assert got["batch_job_sec"] > 0
