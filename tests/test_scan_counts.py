"""Queries at the monthly grain read each raw fact table at most once, tables
stored on the way included."""

import os
import re

import pytest
from pyspark.sql import DataFrameWriter

from finspark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

ONCE = ["cash_flow_fact", "nway_outer", "scenario_overlay", "history_splice", "calibration_stats", "synthetic_history",
        "backtest_verdict", "net_cash_rollup", "elasticity_overlay", "scenario_comparison", "scenario_totals", "forecast_gram",
        "training_frame"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONCE)
def test_fact_tables_are_scanned_once(spark, name, monkeypatch):
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plans.append(_plan(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    plans.append(_plan(QUERIES[name](spark, SF)))
    scans = [line for p in plans for line in p.split("\n") if "FileScan parquet" in line]
    assert scans
    for table in ("lineitem", "orders"):
        n = sum(bool(re.search(rf"/{table}\.parquet", line)) for line in scans)
        assert n <= 1, f"{name}: {table} scanned {n} times"
