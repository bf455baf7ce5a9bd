"""Summarise the executed physical plan of registered queries.

    python tools/plan_report.py [--sf DIR] [name ...]

Runs each query once (``noop`` sink) so AQE's final plan is reported, then
counts shuffles, broadcasts, join strategies, windows, scans and Python
evaluation nodes. Output is a Markdown table (used for PLANS.md).
"""
from __future__ import annotations

import argparse
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [("shuffles", r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobin"),
         ("reused", r"ReusedExchange"),
         ("broadcasts", r"BroadcastExchange"),
         ("smj", r"SortMergeJoin"),
         ("bhj", r"BroadcastHashJoin"),
         ("bnlj", r"BroadcastNestedLoopJoin"),
         ("windows", r"\bWindow\b"),
         ("scans", r"FileScan parquet"),
         ("single_part", r"SinglePartition"),
         ("python", r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas")]


def final_plan(df) -> str:
    """AQE's final plan: execute the Dataset's own physical plan, then read it.

    (A ``write``/``collect`` runs under a new QueryExecution, so reading
    ``executedPlan`` afterwards shows only the initial, pre-AQE plan.)
    """
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


def summarize(df) -> dict:
    plan = final_plan(df)
    out = {k: len(re.findall(p, plan)) for k, p in NODES}
    pushed = set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan))
    out["pushed"] = sum(1 for p in pushed if p.strip())
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from cohort.plans.catalog import QUERIES
    from cohort.session import get_session
    spark = get_session("plan-report", master="local[8]", shuffle_partitions=8,
                        conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plan-ckpt-", dir="/tmp"))
    names = args.names or list(QUERIES)
    cols = [k for k, _ in NODES] + ["pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for n in names:
        s = summarize(QUERIES[n](spark, args.sf))
        print(f"| {n} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
