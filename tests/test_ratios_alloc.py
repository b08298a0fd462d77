"""Ratios (D-20..D-22) and budget allocation (D-23)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from finspark.operators import allocate as al
from finspark.operators import ratios as ra
from tests.conftest import rows


def test_growth_uses_previous_row_and_null_denominators(spark):
    annual = spark.createDataFrame([("c", 2020, 100.0, 0.0), ("c", 2022, 150.0, 10.0), ("c", 2023, None, 5.0)],
                                   "company string, fiscal_year int, total_revenue double, net_income double")
    g = rows(ra.financial_ratios(annual, ["company"], include="growth"), ["fiscal_year", "ratio_name"])
    got = {(r["fiscal_year"], r["ratio_name"]): r["ratio_value"] for r in g}
    # 2022 vs 2020 (gap year ignored); net income growth from 0 is missing
    assert got == {(2022, "Revenue Growth YoY"): 0.5, (2023, "Net Income Growth YoY"): -0.5}


def test_level_ratios_and_quick_ratio_nulls(spark):
    annual = spark.createDataFrame([("c", 2024, 200.0, 80.0, 50.0, 20.0, 400.0, 100.0, 120.0, 60.0, None, 300.0, 5.0, 120.0)],
                                   "company string, fiscal_year int, total_revenue double, gross_profit double, "
                                   "operating_income double, net_income double, total_assets double, total_equity double, "
                                   "total_current_assets double, total_current_liabilities double, inventory double, "
                                   "total_liabilities double, interest_expense double, cost_of_revenue double")
    got = {r["ratio_name"]: r["ratio_value"] for r in ra.financial_ratios(annual, ["company"], include="level").collect()}
    assert got["Gross Profit Margin"] == 0.4 and got["Return on Equity (ROE)"] == 0.2
    assert got["Interest Coverage Ratio"] == 10.0 and got["Current Ratio"] == 2.0
    assert "Quick Ratio (Acid Test)" not in got and "Inventory Turnover" not in got
    assert len(got) == 10


def test_derive_equity_only_when_missing_everywhere(spark):
    df = spark.createDataFrame([("a", 1, 10.0, 4.0, None), ("a", 2, 12.0, 5.0, None),
                                ("b", 1, 10.0, 4.0, 6.0), ("b", 2, 12.0, 5.0, None),
                                ("c", 1, None, 4.0, None)],
                               "company string, y int, total_assets double, total_liabilities double, total_equity double")
    got = {(r["company"], r["y"]): r["total_equity"] for r in ra.derive_equity(df, ["company"]).collect()}
    assert got == {("a", 1): 6.0, ("a", 2): 7.0, ("b", 1): 6.0, ("b", 2): None, ("c", 1): None}


def test_year_end_balance_picks_latest_row(spark):
    bal = spark.createDataFrame([("c", dt.date(2024, 6, 30), 1.0, 1.0, 1.0, 1.0), ("c", dt.date(2024, 12, 31), 2.0, 1.0, 2.0, 3.0)],
                                "company string, balance_date date, total_assets double, inventory_raw_materials double, "
                                "inventory_wip double, inventory_finished_goods double")
    r = ra.year_end_balance(bal, ["company"]).first()
    assert (r["fiscal_year"], r["total_assets"], r["inventory"]) == (2024, 2.0, 6.0)


# The two published caps.
CAPS = {"Baseline": 17_000_000.0, "TariffScenarioExtended": 14_800_000.0}


def test_allocation_of_eleven_departments_uses_the_caps(spark):
    """The optimum of one cap and box bounds: everyone's minimum, then by
    value up to the maximum."""
    depts = [(f"d{k:02d}", 1e5 * (20 - k), 6e4 * (20 - k), 1.2e5 * (20 - k), float(k * 7 % 11)) for k in range(11)]
    df = spark.createDataFrame(depts, "department string, requested_budget double, min_required double, max_plausible double, "
                                      "roi_score double").withColumns({"efficiency_score": F.lit(0.0), "strategic_score": F.lit(0.0)})
    sc = spark.createDataFrame(list(CAPS.items()), "scenario string, cap double")
    out = {(r["scenario"], r["department"]): r["optimized_allocation"] for r in al.allocate_budget(df, sc).collect()}
    for s, cap in CAPS.items():
        left = cap - sum(d[2] for d in depts)
        assert left > 0
        for name, _, low, high, _ in sorted(depts, key=lambda d: -d[4]):
            more = min(left, high - low)
            left -= more
            assert out[(s, name)] == pytest.approx(low + more, abs=1e-3)
        assert sum(v for (k, _), v in out.items() if k == s) == pytest.approx(cap, abs=1e-6)


def test_allocation_properties_and_edge_cases(spark):
    depts = spark.createDataFrame(
        [("a", 100.0, 50.0, 80.0, 1.0), ("b", 100.0, None, None, 1.0), ("c", 100.0, 30.0, 20.0, 2.0), ("d", 10.0, 5.0, 6.0, -1.0)],
        "department string, requested_budget double, min_required double, max_plausible double, roi_score double"
    ).withColumn("efficiency_score", F.lit(0.0)).withColumn("strategic_score", F.lit(0.0))
    sc = spark.createDataFrame([("ok", 200.0), ("infeasible", 50.0)], "scenario string, cap double")
    out = rows(al.allocate_budget(depts, sc), ["scenario", "department"])
    assert {r["scenario"] for r in out} == {"ok"}
    x = {r["department"]: r["optimized_allocation"] for r in out}
    # c: max below min -> fixed at 30; b: bounds 0..150; equal values a/b tie-broken by name
    assert x == {"a": 80.0, "b": 85.0, "c": 30.0, "d": 5.0}
    assert sum(x.values()) == 200.0
