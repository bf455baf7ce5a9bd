"""Sinks (S4, S5): Parquet tables and metric files through the DataFrame writer.

Paths are Hadoop URIs, so the same call writes locally, to HDFS or to an
object store; nothing is written through the driver's local file system.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long metrics table as JSON lines. Metrics are a handful of rows, so one file."""
    metrics.coalesce(1).write.mode(mode).json(path)
