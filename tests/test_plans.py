"""Plan-shape assertions: pushdown, pruning, no Python in the hot path."""
import re

import pytest

from cohort.plans.catalog import QUERIES
from conftest import SF001

LAZY = ["consent_report", "gate_events", "det_edges", "ip_candidates", "affinity_wide", "pair_features",
        "p_best", "interactions", "beta_posterior"]


def _plan(df, final: bool = True):
    """AQE's final plan (execute the Dataset's own plan, then read it), or the initial one.

    Scans are checked on the initial plan: at runtime AQE may drop a join
    whose other side turned out empty and keep the scan only inside a
    reused exchange, whose subtree the final plan does not print.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if not final:
        return plan.toString()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(QUERIES["det_edges"](spark, SF001), final=False)
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    orders = [s for s in scans if "orders.parquet" in s]
    assert orders and all("o_totalprice" not in s and "o_orderdate" not in s for s in orders)
    assert any("PushedFilters: [IsNotNull" in s for s in scans)


def test_no_single_partition_exchange_over_rows(spark):
    plan = _plan(QUERIES["gate_events"](spark, SF001))
    assert "SinglePartition" not in plan


def test_blocking_self_join_reuses_one_shuffle(spark):
    plan = _plan(QUERIES["ip_candidates"](spark, SF001))
    assert "ReusedExchange" in plan
