"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query to completion with the ``noop`` sink (full execution, no
collect) and prints one JSON line with per-query wall-clock seconds.
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohort.plans.catalog import QUERIES  # noqa: E402
from cohort.session import get_session  # noqa: E402

HEADLINE = [
    "consent_report", "gate_events", "det_edges", "ip_candidates", "new_candidates",
    "connected_components", "pairwise_prf", "pair_features", "precision_threshold", "auc",
    "affinity_wide", "interactions", "standardize", "adjusted_rand", "lookalike_lift",
    "p_best", "bandit_replay", "ctr_baseline", "resolve_identities",
    "stream_posterior", "ctr_scores", "lookalike_audience",
]
# Slow fits, timed on request: python bench.py kmeans_segments propensity_gbt ...


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    # One shuffle partition per core; on a single machine, coalescing them only
    # serialises the work (cluster runs keep AQE coalescing on).
    spark = get_session("cohort-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                              "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohort-bench-ckpt-", dir="/tmp"))
    # Warm-up on the smallest scale factor: JVM class loading and JIT of the
    # same code paths are not query work at the measured scale.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["consent_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
