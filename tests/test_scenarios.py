"""Driver shocks, overlay, splice (D-11..D-13), calibration and synthetic
history (D-24, D-25)."""

import datetime as dt

import pytest

from finspark.operators import drivers as drv
from finspark.operators import history as hist
from tests.conftest import rows

COLS = ["economic_activity_index", "consumer_confidence_index", "interest_rate_proxy", "ev_component_cost_index"]


def _month_end(i):
    y, m = 2021 + i // 12, i % 12 + 1
    return dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)


def test_tariff_shock_changes_the_window_by_the_published_ratios(spark):
    """Component cost x 1.25, consumer confidence x 0.85, for
    the 16 months of the window out of 72."""
    base = spark.createDataFrame([(_month_end(i), *[90.0 + i + k for k in range(4)]) for i in range(72)],
                                 "ds date, " + ", ".join(f"{c} double" for c in COLS))
    got = rows(drv.shock_drivers(base, drv.shock_table(spark, "tariff", drv.TARIFF_SHOCKS, *drv.TARIFF_WINDOW)), ["ds"])
    ratio = {"ev_component_cost_index": 1.25, "consumer_confidence_index": 0.85}
    changed = 0
    for g, b in zip(got, rows(base, ["ds"])):
        inside = dt.date.fromisoformat(drv.TARIFF_WINDOW[0]) <= g["ds"] <= dt.date.fromisoformat(drv.TARIFF_WINDOW[1])
        changed += inside
        assert g["scenario"] == "tariff"
        for c in COLS:
            assert g[c] == pytest.approx(b[c] * (ratio.get(c, 1.0) if inside else 1.0), rel=1e-12)
    assert len(got) == 72 and changed == 16


def test_shock_inverse_restores_and_absent_driver_skipped(spark):
    base = spark.createDataFrame([(dt.date(2024, 1, 31), 100.0)], "ds date, cost double")
    up = drv.shock_table(spark, "s", [("cost", 0.25), ("missing", 0.5)], "2024-01-01", "2024-12-31")
    once = drv.shock_drivers(base, up).drop("scenario")
    back = drv.shock_drivers(once, drv.shock_table(spark, "s", [("cost", 1 / 1.25 - 1)], "2024-01-01", "2024-12-31"))
    assert back.first()["cost"] == pytest.approx(100.0)


def test_overlay_window_inclusive_and_missing_alt(spark):
    base = spark.createDataFrame([(dt.date(2025, m, 28), float(m)) for m in (1, 2, 3, 4)], "ds date, x double")
    alt = spark.createDataFrame([(dt.date(2025, m, 28), 10.0 * m) for m in (1, 2)], "ds date, x double")
    got = [r["x"] for r in rows(drv.overlay_window(base, alt, "2025-02-28", "2025-03-28"), ["ds"])]
    assert got == [1.0, 20.0, None, 4.0]


def test_splice_normalises_month_start(spark):
    syn = spark.createDataFrame([(dt.date(2020, 12, 1), 1.0), (dt.date(2021, 1, 1), 2.0)], "ds date, y double")
    act = spark.createDataFrame([(dt.date(2021, 1, 31), 3.0), (dt.date(2021, 2, 28), 4.0)], "ds date, y double")
    got = [(str(r["ds"]), r["y"], r["source"]) for r in rows(drv.splice_history(syn, act), ["ds"])]
    # G2: the synthetic January (month start) does not duplicate the actual January
    assert got == [("2020-12-31", 1.0, "synthetic"), ("2021-01-31", 3.0, "actual"), ("2021-02-28", 4.0, "actual")]


def test_training_frame_drops_rows_without_drivers(spark):
    t = spark.createDataFrame([(dt.date(2021, m, 1), float(m)) for m in (1, 2, 3)], "ds date, y double")
    d = spark.createDataFrame([(dt.date(2021, 1, 1), 1.0), (dt.date(2021, 2, 1), None)], "ds date, z double")
    assert drv.training_frame(t, d).count() == 1


def test_calibration_uses_the_first_year(spark):
    data = [(_month_end(i), 1000.0 + i, (1000.0 + i) * (0.6 + 0.001 * i), (1000.0 + i) * 0.15) for i in range(30)]
    df = spark.createDataFrame(data, "ds date, inflow_operating_revenue double, outflow_cogs double, outflow_opex double")
    c = hist.calibrate(df).first()
    assert c["avg_revenue"] == pytest.approx(1005.5) and c["n_months"] == 12
    assert c["avg_cogs_ratio"] == pytest.approx(0.6055, abs=1e-12)
    # fixed value: the operating cost share of the patched months
    assert c["avg_opex_ratio"] == pytest.approx(0.15, abs=1e-12)


def test_synthetic_history_constant_ratios_and_fallbacks(spark):
    macro = spark.createDataFrame([(dt.date(2000 + i // 12, i % 12 + 1, 1), 100.0 + i, 1.0 + 0.01 * i) for i in range(36)],
                                  "ds date, total_vehicle_sales double, cpi double")
    calib = spark.createDataFrame([(5e8, 0.6, 0.15)], "avg_revenue double, avg_cogs_ratio double, avg_opex_ratio double")
    out = rows(hist.synthetic_history(macro, calib, noise_std=0.0), ["ds"])
    mean_cpi = sum(1.0 + 0.01 * i for i in range(36)) / 36
    for r in out:
        assert r["outflow_cogs"] / r["inflow_operating_revenue"] * mean_cpi / r["ev_component_cost_index"] == pytest.approx(0.6)
        assert r["outflow_opex"] / r["inflow_operating_revenue"] == pytest.approx(0.15)
    last12 = sum(r["inflow_operating_revenue"] for r in out[-12:]) / 12
    assert last12 == pytest.approx(5e8)
    noisy = rows(hist.synthetic_history(macro, None), ["ds"])
    ratio = [n["inflow_operating_revenue"] / (r["inflow_operating_revenue"] / 5e8 * 5e8) for n, r in zip(noisy, out)]
    assert 0.9 < min(ratio) and max(ratio) < 1.1 and len(set(ratio)) > 1
