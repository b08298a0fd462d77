"""Forecast fit (D-14), holdout metrics / backtest (D-15, D-16), roll-up (D-17..D-19)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from finspark.operators import forecast as fc
from finspark.operators import metrics as me
from finspark.operators import rollup as ru
from tests.conftest import rows


def _month(i):
    y, m = 2010 + i // 12, i % 12 + 1
    nd = dt.date(y + (m == 12), m % 12 + 1, 1)
    return nd - dt.timedelta(days=1)


def test_fit_recovers_known_multiplicative_model(spark):
    rng = np.random.default_rng(0)
    data = []
    for s, (a, b, g) in {"s1": (10.0, 0.05, 0.1), "s2": (5.0, -0.02, -0.2)}.items():
        for i in range(120):
            d = _month(i)
            z = float(rng.normal())
            doy = d.timetuple().tm_yday
            eta = a + b * i / 12 + 0.1 * math.sin(2 * math.pi * doy / 365.25) + g * z
            data.append((s, d, math.exp(eta), z))
    df = spark.createDataFrame(data, "s string, ds date, y double, z double")
    m = fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=6, ridge=1e-6)
    coef = {(r["s"], r["term"]): r["coef"] for r in fc.coefficient_table(m, ["s"], ["z"]).collect()}
    sd = {r["s"]: r["sd"] for r in df.filter(F.col("ds") <= dt.date(2019, 6, 30)).groupBy("s").agg(F.stddev("z").alias("sd")).collect()}
    assert coef[("s1", "trend")] == pytest.approx(0.05, abs=1e-3)
    assert coef[("s2", "trend")] == pytest.approx(-0.02, abs=1e-3)
    assert coef[("s1", "sin1")] == pytest.approx(0.1, abs=2e-3)
    assert coef[("s1", "z")] / sd["s1"] == pytest.approx(0.1, abs=2e-3)
    assert coef[("s2", "z")] / sd["s2"] == pytest.approx(-0.2, abs=2e-3)
    fut = fc.future_frame(df.select("s", "ds", "y"), m, df.select("s", "ds", "z"), ["s"], "ds", 12, ["z"], ["s"])
    p = fc.predict_forecast(fut, m, ["s"], "ds", ["z"])
    assert p.count() == 2 * (120 - 6 + 12)
    h = p.filter(F.col("actual").isNotNull()).withColumn("ape", F.abs(F.col("yhat") / F.col("actual") - 1))
    assert h.agg(F.max("ape")).first()[0] < 0.01


def test_additive_when_nonpositive_and_constant_driver(spark):
    data = [("a", _month(i), float(i % 3) - 1.0, 5.0) for i in range(40)]
    df = spark.createDataFrame(data, "s string, ds date, y double, z double")
    m = fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=6).first()
    assert m["_multiplicative"] is False and m["_sd_z"] == 0.0
    tiny = spark.createDataFrame([("t", _month(i), 1.0, 1.0) for i in range(6)], "s string, ds date, y double, z double")
    assert fc.fit_forecast(tiny, ["s"], "ds", "y", ["z"], holdout=6).count() == 0


def test_linear_trend_exact(spark):
    df = spark.createDataFrame([("a", x, 3.0 + 2.0 * x) for x in range(10)], "k string, t int, y double")
    r = fc.linear_trend(df, ["k"], "t", "y").first()
    assert (r["n"], r["slope"], r["intercept"]) == (10, 2.0, 3.0)


def test_holdout_metrics_and_verdict(spark):
    df = spark.createDataFrame([("a", i, 100.0, 100.0 + (10.0 if i >= 4 else 0.0)) for i in range(8)] +
                               [("z", i, 0.0 if i == 7 else 10.0, 11.0) for i in range(8)],
                               "k string, ds int, y double, yhat double")
    m = {r["k"]: r for r in me.holdout_metrics(df, ["k"], n=4).collect()}
    assert (m["a"]["mae"], m["a"]["rmse"], m["a"]["mape"]) == (10.0, 10.0, 10.0)
    assert m["z"]["mape"] == pytest.approx(10.0)  # zero actual skipped
    v = spark.createDataFrame([(0.05,), (0.15,), (0.5,), (None,)], "m double")
    assert [r["v"] for r in v.select(me.verdict(F.col("m")).alias("v")).collect()] == [
        "EXCELLENT", "ACCEPTABLE", "VOLATILE", "VOLATILE"]


def test_backtest_and_scaled_truth(spark):
    df = spark.createDataFrame([("a", dt.date(2023, m, 28), 100.0 * m, 110.0 * m) for m in range(1, 7)],
                               "k string, ds date, y double, yhat double")
    b = me.backtest(df, ["k"], "2023-04-01").first()
    assert b["n_test"] == 3 and b["mape"] == pytest.approx(0.1) and b["verdict"] == "ACCEPTABLE"
    t = me.scaled_truth(df, ["k"], "y", 1000.0, "2023-04-01", window=2)
    assert rows(t, ["ds"])[0]["y"] == pytest.approx(100.0 * 1000.0 / 250.0)


def test_rollup_rules(spark):
    comp = spark.createDataFrame(
        [("e", dt.date(2024, 1, 31), 100.0, None, 50.0, None, 10.0, None),
         ("e", dt.date(2024, 2, 29), None, 200.0, None, 80.0, None, 20.0),
         ("e", dt.date(2024, 3, 31), None, 10.0, None, 80.0, None, 20.0)],
        "k string, ds date, inflow_operating_revenue_actual double, inflow_operating_revenue_forecast double, "
        "outflow_cogs_actual double, outflow_cogs_forecast double, outflow_opex_actual double, outflow_opex_forecast double")
    hist = spark.createDataFrame([("e", dt.date(2024, 1, 31), 1.0, 2.0, 1200.0, 5.0, 7.0)],
                                 "k string, ds date, interest_expense double, taxes double, long_term_debt double, "
                                 "net_debt_financing_activity double, capex_outflow double")
    capex = spark.createDataFrame([("e", dt.date(2024, 2, 29), 4.0)], "k string, ds date, capex_outflow double")
    out = {str(r["ds"]): r for r in ru.net_cash_rollup(comp, hist, capex, ["k"]).collect()}
    jan, feb, mar = out["2024-01-31"], out["2024-02-29"], out["2024-03-31"]
    assert (jan["outflow_interest_final"], jan["outflow_taxes_final"]) == (1.0, 2.0)
    assert feb["outflow_interest_final"] == pytest.approx(1200.0 * 0.03 / 12)
    assert feb["outflow_taxes_final"] == pytest.approx((100.0 - 3.0) * 0.25)
    assert mar["outflow_taxes_final"] == 0.0  # negative EBT pays no tax
    assert feb["net_investing_cash_flow"] == -4.0 and mar["net_investing_cash_flow"] == 0.0
    assert jan["net_change_in_cash_total"] == pytest.approx(100 - 50 - 10 - 1 - 2 + 5)
    every = {str(r["ds"]): r for r in ru.net_cash_rollup(comp, hist, None, ["k"], mode="everywhere").collect()}
    assert every["2024-02-29"]["net_investing_cash_flow"] == 0.0  # capex only from history (G7)


def test_elasticity_and_comparison(spark):
    comp = spark.createDataFrame([(dt.date(2024, 1, 31), 100.0, None, 10.0, 1.0), (dt.date(2024, 2, 29), None, 100.0, 10.0, 1.0)],
                                 "ds date, inflow_operating_revenue_actual double, inflow_operating_revenue_forecast double, "
                                 "outflow_cogs_forecast double, outflow_opex_forecast double").withColumns(
        {"outflow_cogs_actual": F.lit(None).cast("double"), "outflow_opex_actual": F.lit(None).cast("double")})
    base = spark.createDataFrame([(d, 100.0, 100.0, 100.0) for d in (dt.date(2024, 1, 31), dt.date(2024, 2, 29))],
                                 "ds date, economic_activity_index double, consumer_confidence_index double, ev_component_cost_index double")
    alt = base.withColumn("economic_activity_index", F.col("economic_activity_index") * 0.9)
    e = {str(r["ds"]): r["inflow_operating_revenue_final"] for r in ru.elasticity_overlay(comp, base, alt).collect()}
    assert e["2024-01-31"] == 100.0 and e["2024-02-29"] == pytest.approx(100.0 * (1 - 0.06))
    a = spark.createDataFrame([(dt.date(2024, 1, 31), 10.0), (dt.date(2024, 2, 29), -5.0)], "ds date, net_change_in_cash_total double")
    b = spark.createDataFrame([(dt.date(2024, 1, 31), 12.0)], "ds date, net_change_in_cash_total double")
    c = {str(r["ds"]): r for r in ru.compare_scenarios(a, b, window=("2024-01-01", "2024-01-31")).collect()}
    assert c["2024-01-31"]["delta"] == 2.0 and c["2024-01-31"]["pct_delta"] == 0.2 and c["2024-01-31"]["in_window"]
    assert c["2024-02-29"]["alt_value"] is None and c["2024-02-29"]["in_window"] is False
    tot = ru.scenario_totals(ru.compare_scenarios(a, b)).first()
    assert (tot["base_total"], tot["alt_total"]) == (5.0, 12.0)


def _driven_series(n_series=8, n=120, noise=0.05):
    """Monthly series that follow trend, season and one driver."""
    rng = np.random.default_rng(5)
    out = []
    for k in range(n_series):
        z = rng.normal(size=n)
        for i in range(n):
            eta = 8 + 0.004 * i + 0.1 * math.sin(2 * math.pi * i / 12) + 0.05 * z[i] + noise * rng.normal()
            out.append((f"s{k}", _month(i), math.exp(eta), float(z[i])))
    return out


def test_backtest_of_the_model_is_acceptable_and_bounds_cover(spark):
    """D-14 + D-16: train before a cutoff, predict the year after it with the
    actual drivers; the accepted verdict is below 20% MAPE, and the 80% bounds
    hold at least 70% of the months that the model never saw."""
    df = spark.createDataFrame(_driven_series(), "s string, ds date, y double, z double")
    cutoff = _month(107)
    model = fc.fit_forecast(df.filter(F.col("ds") <= F.lit(cutoff)), ["s"], "ds", "y", ["z"], holdout=0)
    pred = fc.predict_forecast(df, model, ["s"], "ds", ["z"])
    res = me.backtest(pred.withColumnRenamed("actual", "y"), ["s"], str(_month(108))).collect()
    assert len(res) == 8 and all(r["n_test"] == 12 and r["mape"] < 0.20 for r in res)
    unseen = pred.filter(F.col("ds") > F.lit(cutoff))
    share = unseen.agg(F.avg(F.col("actual").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))).first()[0]
    assert share >= 0.7


def test_short_series_are_reported_and_claim_no_interval(spark):
    rows_ = [(k, _month(i), 10.0 + i, float(i % 4)) for k, n in (("long", 60), ("few", 15), ("short", 6)) for i in range(n)]
    df = spark.createDataFrame(rows_, "s string, ds date, y double, z double")
    model = fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=6)
    got = {r["s"]: (r["n_rows"], r["n_fit"], r["status"]) for r in fc.fit_report(df, model, ["s"]).collect()}
    assert got == {"long": (60, 54, "fitted"), "few": (15, 9, "fitted_no_interval"), "short": (6, 0, "skipped_too_short")}
    p = fc.predict_forecast(df.filter("s = 'few'"), model, ["s"], "ds", ["z"]).first()
    assert p["yhat"] is not None and p["yhat_lower"] is None and p["yhat_upper"] is None


def test_gram_fit_equals_numpy_lstsq_on_same_design(spark):
    rng = np.random.default_rng(7)
    data = [("s", _month(i), float(np.exp(3 + 0.01 * i + 0.2 * rng.normal())), float(rng.normal()), float(rng.normal()))
            for i in range(60)]
    df = spark.createDataFrame(data, "s string, ds date, y double, a double, b double")
    m = fc.fit_forecast(df, ["s"], "ds", "y", ["a", "b"], holdout=0, ridge=0.0, interval_calibration=0)
    stats = fc.series_stats(df, ["s"], "ds", "y", ["a", "b"])
    x = fc.design(df, stats, ["s"], "ds", ["a", "b"]).withColumn("_t", fc.target_expr("y"))
    feats = fc.feature_names(3, ["a", "b"])
    rows_ = x.select(*[(F.col(f) / fc.UNIT).alias(f) for f in feats],
                     (F.col("_t") / fc.UNIT * F.col("_ysd") + F.col("_ymu")).alias("_t")).collect()
    X = np.array([[r[f] for f in feats] for r in rows_])
    t = np.array([r["_t"] for r in rows_])
    beta = np.linalg.lstsq(X, t, rcond=None)[0]
    got = np.array(m.first()["beta"])
    assert np.allclose(got, beta, rtol=1e-8, atol=1e-9)


def test_null_target_zero_fill_makes_all_zero_series_additive(spark):
    data = [("z", _month(i), None, float(i % 5)) for i in range(30)] + \
           [("p", _month(i), 100.0 + i, float(i % 5)) for i in range(30)]
    df = spark.createDataFrame(data, "s string, ds date, y double, z double")
    m = {r["s"]: r for r in fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=6, null_target="zero").collect()}
    assert m["z"]["_multiplicative"] is False and m["p"]["_multiplicative"] is True
    assert set(fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=6).select("s").toPandas()["s"]) == {"p"}
