"""Memory that idle Python workers hold after near duplicates were looked for (run by
test_pipeline.py in a session of its own): prints the MB of the largest one."""

from __future__ import annotations

import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pyarrow as pa  # noqa: E402

from clickpath.llm import common, jaccard_join  # noqa: E402
from clickpath.session import build_session, checkpoint_dir  # noqa: E402


def held(batches):
    for _ in batches:
        pass
    kb = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    time.sleep(0.5)  # so that every task has a worker of its own
    yield pa.RecordBatch.from_pydict({"mb": [int(kb[0]) // 1024]})


if __name__ == "__main__":
    spark = build_session(master="local[2]", shuffle_partitions=8, app_name="worker-memory")
    checkpoint_dir(spark)
    common.ship(spark)
    docs = spark.range(0, 6000, 1, 2).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 400), i -> concat('w', hash(id div 2, i)))) AS text")
    docs, path = common.write_table(spark, docs, "texts")
    assert jaccard_join.near_duplicates(docs, 5, 80).where("doc_id = component_id").count() == 3000
    largest = max(r["mb"] for r in spark.range(0, 4, 1, 4).mapInArrow(held, "mb long").collect())
    common.remove_table(spark, path)
    spark.stop()
    print("largest", largest)
