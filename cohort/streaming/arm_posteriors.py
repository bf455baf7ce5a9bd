"""Streaming arm posteriors (X3): the Beta-Binomial update of B1 over a
reward stream, as a Structured Streaming stateful aggregation.

State is one row per (test, arm) - or per (window, test, arm) when an event
time and a window are given, in which case the watermark bounds the state
and late rows beyond it are dropped by Spark. Output goes through
``foreachBatch`` to a Parquet table (complete mode rewrites the table each
micro-batch; the table stays as small as the state), and the checkpoint
location makes the query restartable after a failure.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.operators.campaign import beta_posterior
from cohort.session import ensure_checkpoint_dir
from cohort.sources.tables import table_path


def posterior_stream(stream: DataFrame, group: str = "test", arm: str = "arm", reward: str = "reward",
                     ts: str | None = None, window: str | None = None,
                     watermark: str = "1 day") -> DataFrame:
    """Streaming DataFrame of running posteriors per (group, arm)."""
    keys = [F.col(group), F.col(arm)]
    if ts is not None and window is not None:
        stream = stream.withWatermark(ts, watermark)
        keys = [F.window(ts, window).alias("window")] + keys
    counts = stream.groupBy(*keys).agg(F.count_if(F.col(reward) == 1).alias("successes"),
                                       F.count_if(F.col(reward) == 0).alias("failures"))
    return beta_posterior(counts.withColumn("trials", F.col("successes") + F.col("failures")))


def run_available(posteriors: DataFrame, out_path: str, checkpoint: str, windowed: bool = False):
    """Process everything available now, then stop; results land in ``out_path``.

    Unwindowed: complete mode, each micro-batch overwrites the (small) table.
    Windowed: update mode, changed windows are appended; read with :func:`latest`.
    """
    save_mode = "append" if windowed else "overwrite"

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode(save_mode).parquet(out_path)

    q = (posteriors.writeStream.outputMode("update" if windowed else "complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def event_time(col: str) -> F.Column:
    """Event time usable for watermarks, independent of the session time zone.

    Watermarks need ``TIMESTAMP``; a ``TIMESTAMP_NTZ`` wall clock is read as
    UTC (``unix_timestamp`` of an NTZ value ignores the session zone), so
    day windows fall on the same calendar days under any session setting.
    Second precision is kept.
    """
    return F.timestamp_seconds(F.unix_timestamp(F.col(col)))


def window_day(window_col: str = "window") -> F.Column:
    """UTC calendar day (``yyyy-MM-dd``) of a window's start, zone-independent."""
    return F.date_from_unix_date((F.unix_seconds(F.col(f"{window_col}.start")) / 86400).cast("int")).cast("string")


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Collapse appended update-mode rows to the latest per key (counts only grow)."""
    cols = [c for c in updates.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.col("trials"))
    return updates.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def read_stream_table(spark: SparkSession, directory: str, name: str, schema,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the rows of ``{directory}/{name}.parquet``, a file or a folder of files (new files are picked up).

    ``max_files_per_trigger`` bounds a micro-batch during a backfill; by
    default each trigger takes everything that is new. A source without rows raises.
    """
    path = table_path(directory, name)
    if spark.read.schema(schema).parquet(path).isEmpty():
        raise ValueError(f"no rows to stream in {path}")
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # As a glob the path may name a file or a folder; a plain path must be a folder.
    return r.parquet(f"{directory.rstrip('/')}/{{{name}.parquet}}")


def scratch_paths(spark: SparkSession, tag: str) -> tuple[str, str]:
    """Fresh output and checkpoint paths under the session's checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/{tag}-{uuid.uuid4().hex[:12]}"
    return base + "/out", base + "/_checkpoint"
