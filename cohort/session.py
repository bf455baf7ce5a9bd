"""Session helpers.

``get_session`` only *adds* defaults: on a cluster the master, memory and
checkpoint directory come from ``spark-submit`` and are never overridden.
``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and
only invents a directory for local-mode runs (tests, laptop benches).
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even when that costs one extra shuffle:
    # blocking reuses the anti join's partitioning for the pair self-join,
    # and without this AQE keeps the reuse and leaves the hot value in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Iterative operators checkpoint every step; delete files no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "cohort", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors in one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only in local mode.

    Reliable checkpoints (``Dataset.checkpoint``) survive executor loss;
    local checkpoints do not, so they are never used here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/GCS) so iterative operators can truncate lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohort-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable, eager checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
