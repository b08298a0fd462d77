"""D-09 / D-10: a four-year fact rebuilt by plain rules, and unit rows."""

import datetime as dt
import random

import pytest

from finspark.operators import cashflow as cf
from tests.conftest import rows

INPUTS = ["revenue", "cogs_materials", "cogs_labor", "cogs_overhead", "operating_expenses",
          "interest_expense", "taxes"]


def month_end(i, start=2021):
    y, m = start + i // 12, i % 12 + 1
    return dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)


def test_four_year_fact_follows_the_rules(spark):
    r = random.Random(11)
    ds = [month_end(i) for i in range(48)]
    income = [[r.uniform(1e6, 5e6)] + [r.uniform(1e4, 9e5) for _ in range(3)] + [r.choice([0.5, 2e5]) * r.random()]
              + [r.uniform(1e3, 1e5) for _ in range(2)] for _ in ds]
    debt = [(r.uniform(1e6, 2e6), r.uniform(1e5, 2e5)) for _ in ds]
    spend = [(d.replace(day=k), r.uniform(10, 1e5)) for d in ds[::2] for k in (3, 17)]
    index = [100 + r.random() for _ in ds]
    out = rows(cf.cash_flow_fact(
        spark.createDataFrame([(d, *v) for d, v in zip(ds, income)], "ds date, " + ", ".join(f"{c} double" for c in INPUTS)),
        spark.createDataFrame(spend, "ds date, capex_outflow double"),
        spark.createDataFrame([(d, v) for d, v in list(zip(ds, index))[:-3]], "ds date, idx double"),
        spark.createDataFrame([(d, *v) for d, v in zip(ds, debt)], "ds date, long_term_debt double, short_term_debt double")), ["ds"])
    assert [x["ds"] for x in out] == ds
    patched = 0
    for i, (x, v) in enumerate(zip(out, income)):
        rev, opex = v[0], v[4]
        patched += opex < 0.01 * rev
        opex = 0.15 * rev if opex < 0.01 * rev else opex
        operating = rev - (sum(v[1:4]) + opex + v[5] + v[6])
        capex = sum(round(a, 4) for d, a in spend if (d.year, d.month) == (ds[i].year, ds[i].month))
        financing = sum(debt[i]) - sum(debt[i - 1]) if i else 0.0
        want = {"outflow_cogs": sum(v[1:4]), "outflow_opex": opex, "net_operating_cash_flow": operating, "capex_outflow": capex,
                "net_investing_cash_flow": -capex, "net_financing_cash_flow": financing, "idx": index[min(i, 44)],
                "net_change_in_cash_total": operating - capex + financing}
        for c, w in want.items():
            assert x[c] == pytest.approx(w, rel=1e-9, abs=1e-3), (c, ds[i])
    assert 0 < patched < 48


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    inc = spark.createDataFrame([(dt.date(2024, 1, 31), nan, 10.0)], "ds date, revenue double, taxes double")
    cx = spark.createDataFrame([(dt.date(2024, 1, 31), nan), (dt.date(2024, 1, 31), 2.0)], "ds date, capex_outflow double")
    x = cf.cash_flow_fact(inc, cx).first()
    assert (x["revenue"], x["outflow_opex"], x["net_change_in_cash_total"]) == (0.0, 0.0, -12.0)


def test_patch_is_strict_and_nulls_are_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), 1000.0, 10.0), (dt.date(2024, 2, 29), 1000.0, 9.99),
                                (dt.date(2024, 3, 31), None, None)], "ds date, revenue double, operating_expenses double")
    out = rows(cf.cash_flow_fact(df), ["ds"])
    assert [r["outflow_opex"] for r in out] == [10.0, 150.0, 0.0]
    assert all(r["net_change_in_cash_total"] == r["net_operating_cash_flow"] for r in out)


def test_missing_month_ffill_and_debt_diff_before_join(spark):
    inc = spark.createDataFrame([("e", dt.date(2024, m, 1), 100.0) for m in (1, 2, 3)],
                                "k string, ds date, revenue double")
    ind = spark.createDataFrame([(dt.date(2024, 1, 31), 5.0)], "ds date, idx double")
    debt = spark.createDataFrame([("e", dt.date(2023, 12, 31), 10.0, 0.0), ("e", dt.date(2024, 2, 29), 15.0, None)],
                                 "k string, ds date, long_term_debt double, short_term_debt double")
    out = rows(cf.cash_flow_fact(inc, indicators=ind, debt=debt, keys=["k"]), ["ds"])
    assert [r["idx"] for r in out] == [5.0, 5.0, 5.0]
    # diff is taken on debt rows (Dec -> Feb = +5), January has no debt row -> 0
    assert [r["net_debt_financing_activity"] for r in out] == [0.0, 5.0, 0.0]


def test_legs_give_what_capex_and_debt_give(spark):
    ds = [month_end(i) for i in range(5)]
    inc = spark.createDataFrame([("e", d, 100.0) for d in ds], "k string, ds date, revenue double")
    both = spark.createDataFrame([("e", d, 7.0 * i if i % 2 else None, 10.0 + i, None) for i, d in enumerate(ds[1:])],
                                 "k string, ds date, capex_outflow double, long_term_debt double, short_term_debt double")
    apart = cf.cash_flow_fact(inc, both.select("k", "ds", "capex_outflow"), None,
                              both.select("k", "ds", "long_term_debt", "short_term_debt"), ["k"])
    assert rows(cf.cash_flow_fact(inc, keys=["k"], legs=both), ["ds"]) == rows(apart, ["ds"])
    with pytest.raises(ValueError):
        cf.cash_flow_fact(inc, capex=both, keys=["k"], legs=both)
