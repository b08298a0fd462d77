"""Plan-shape guards for every registered query: no cross / nested-loop joins,
no row-at-a-time Python, Arrow-batched Python only in the forecast solve,
and single-partition exchanges only on top of partial aggregates (global
scalars) or the per-partition offset tables."""

import os

import pytest

from finspark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas")
PYTHON_ALLOWED = {"forecast_components", "forecast_fit_check", "scenario_forecast_comparison"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    if name not in PYTHON_ALLOWED:
        assert "MapInPandas" not in plan, name
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            assert "partial_" in child or "keys=[_pid" in child, f"{name}: {child.strip()[:120]}"


def test_flagship_scans_are_pruned_and_pushed(spark):
    plan = QUERIES["cash_flow_fact"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the columns the income and driver sums need
    for line in plan.split("\n"):
        if "FileScan parquet" in line and "lineitem" in line:
            assert "l_comment" not in line and "ReadSchema" in line
            assert "l_linenumber" not in line and "l_orderkey" not in line
