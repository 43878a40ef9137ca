"""Session helpers for tests, benchmarks and the batch runner.

Library functions never create or configure a session; the caller owns it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the analyses are tuned for. AQE re-plans joins at run time (broadcast
# of small sides after measuring them, skew splitting, partition coalescing).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # partial top-n before the shuffle also for sample totals above 1000
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Python call-site capture for error messages costs several JVM round trips
    # per Column call while a DataFrame is declared; off for production runs
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "clickpath",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CLICKPATH_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never overridden. Only when it is
    unset on a local master (tests) a fresh scratch folder is taken; on any
    other master, and for a Spark Connect session, the setting is required.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="clickpath-ckpt-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder: later plans read it from there, and a
    lost executor costs only its own tasks. Spark removes the files when nothing uses them any more
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def describe_jobs(spark: SparkSession, text: str) -> None:
    """Label the jobs submitted next from this thread (best effort)."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:  # noqa: BLE001 - Spark Connect has no job descriptions
        pass
