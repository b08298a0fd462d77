"""Piecewise trend and bounds by lead month (D-14)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from finspark.operators import forecast as fc
from finspark.operators import piecewise as pw


def _month(i, year=2005):
    y, m = year + i // 12, i % 12 + 1
    return dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)


def test_hinge_grams_from_prefix_sums_equal_the_direct_ones():
    r = np.random.default_rng(1)
    n, p = 60, 4
    t = np.arange(n) / 12.0
    x = np.column_stack([np.ones(n), t, r.normal(size=(n, p - 2))])
    y = r.normal(size=n)
    breaks, bounds = np.array([10, 25, 40]), np.array([10, 25, 40, 47, 53])
    bucket = np.searchsorted(bounds, np.arange(n))
    aug = np.column_stack([x, y])
    iu = np.triu_indices(p)
    rows = [[{"bucket": int(b), "sums": [*(x[bucket == b].T @ x[bucket == b])[iu], *(x[bucket == b].T @ y[bucket == b]),
                                         y[bucket == b] @ y[bucket == b], (bucket == b).sum()]} for b in range(6)]]
    prefix, count = pw.prefix_grams(rows, p)
    assert np.allclose(prefix[0, -1], aug.T @ aug) and count[0, -1] == n
    c = breaks[None, :] / 12.0
    at = np.searchsorted(bounds, breaks)[None, :] + 1
    for upto, rows_in in ((6, n), (4, 48), (2, 26)):
        full = np.column_stack([x, np.maximum(t[:, None] - c, 0), y])[:rows_in]
        got = pw.with_hinges(prefix, np.array([upto]), at, c)[0]
        assert np.allclose(got, full.T @ full), upto


def test_descent_meets_the_optimality_conditions():
    r = np.random.default_rng(2)
    a = r.normal(size=(20, 30, 6))
    a = np.swapaxes(a, 1, 2) @ a
    b, lam = r.normal(size=(20, 6)) * 10, r.uniform(0, 12, 20)
    d = pw.l1_path(a, b, lam)
    g = b - np.einsum("mij,mj->mi", a, d)
    assert (np.abs(g[d == 0]) <= np.broadcast_to(lam[:, None], d.shape)[d == 0] + 1e-6).all()
    assert np.allclose(g[d != 0], (np.sign(d) * lam[:, None])[d != 0], atol=1e-6)
    assert (d == 0).any() and (d != 0).any()


def test_planted_breaks_are_found(spark):
    r = np.random.default_rng(3)
    n, hold = 126, 6
    # candidates of 120 training months: floor(j * floor(119 * 0.8) / 12)
    planted = {"up": [(47, 0.6)], "down_up": [(31, -0.5), (71, 0.9)], "straight": []}
    rows = []
    for s, breaks in planted.items():
        for i in range(n):
            d = _month(i)
            z = float(r.normal())
            eta = 3 + 0.1 * i / 12 + sum(g * max(i - c, 0) / 12 for c, g in breaks)
            eta += 0.1 * np.sin(2 * np.pi * d.timetuple().tm_yday / 365.25) + 0.05 * z + r.normal() * 0.01
            rows.append((s, d, float(np.exp(eta)), z))
    df = spark.createDataFrame(rows, "s string, ds date, y double, z double").repartition(4)
    model = pw.fit_piecewise(df, ["s"], "ds", "y", ["z"], holdout=hold).cache()
    got = {x["s"]: x for x in model.collect()}
    for s, breaks in planted.items():
        at, change = np.array(got[s]["break_at"]) * 12, np.array(got[s]["slope_change"])
        big = np.abs(change) > 0.15
        assert len(at[big]) >= len(breaks)
        for c, g in breaks:  # the change around the planted month adds up to the planted one
            near = np.abs(at - c) <= 9
            assert near.any() and change[near].sum() == pytest.approx(g, abs=0.12), (s, at, change)
        far = [k for k, a in enumerate(at) if all(abs(a - c) > 9 for c, _ in breaks)]
        assert (np.abs(change[far]) < 0.15).all(), (s, at, change)
    # it forecasts what a straight trend can't
    straight = fc.fit_forecast(df, ["s"], "ds", "y", ["z"], holdout=hold)
    err = {}
    for name, p in (("bent", pw.predict_piecewise(df, model, ["s"], "ds", ["z"])),
                    ("straight", fc.predict_forecast(df, straight, ["s"], "ds", ["z"]))):
        late = p.filter(F.col("ds") > _month(n - hold - 1)).withColumn("e", F.abs(F.col("yhat") / F.col("actual") - 1))
        err[name] = {x["s"]: x["e"] for x in late.groupBy("s").agg(F.avg("e").alias("e")).collect()}
    assert max(err["bent"].values()) < 0.05 and err["straight"]["down_up"] > 3 * err["bent"]["down_up"]


def test_bounds_by_lead_cover_unseen_months(spark):
    r = np.random.default_rng(4)
    n_series, n, ahead = 150, 120, 18
    rows = []
    for s in range(n_series):
        walk = np.cumsum(r.normal(size=n + ahead) * 0.03)  # errors grow with the lead
        for i in range(n + ahead):
            d = _month(i)
            eta = 4 + 0.05 * i / 12 + 0.1 * np.cos(2 * np.pi * d.timetuple().tm_yday / 365.25) + walk[i] + r.normal() * 0.01
            rows.append((s, d, float(np.exp(eta))))
    df = spark.createDataFrame(rows, "s int, ds date, y double").repartition(8)
    model = pw.fit_piecewise(df, ["s"], "ds", "y", holdout=ahead).cache()
    assert model.count() == n_series
    p = pw.predict_piecewise(df, model, ["s"], "ds").filter("lead > 0")
    p = p.withColumn("inside", ((F.col("actual") >= F.col("yhat_lower")) & (F.col("actual") <= F.col("yhat_upper"))).cast("int"))
    third = F.floor((F.col("lead") - 1) / 6)
    got = {x["k"]: x["c"] for x in p.groupBy(third.alias("k")).agg(F.avg("inside").alias("c")).collect()}
    assert set(got) == {0, 1, 2} and all(0.70 <= c <= 0.93 for c in got.values()), got
    # bounds never narrow with the lead
    w = p.withColumn("w", F.log(F.col("yhat_upper") / F.col("yhat_lower"))).toPandas().sort_values(["s", "lead"])
    assert (w.groupby("s")["w"].diff().dropna() >= -1e-9).all()


def test_short_empty_and_additive_series(spark):
    rows = [("short", _month(i), float(i + 1)) for i in range(14)] + [("tiny", _month(i), 1.0) for i in range(7)]
    rows += [("neg", _month(i), float(i % 5) - 2.0) for i in range(60)] + [("flat", _month(i), 5.0) for i in range(60)]
    rows += [("gap", _month(i), None if i % 7 == 3 else float(10 + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, ds date, y double")
    m = {r["s"]: r for r in pw.fit_piecewise(df, ["s"], holdout=6).collect()}
    assert set(m) == {"short", "neg", "flat", "gap"}  # tiny: one training row
    assert m["short"]["break_at"] == [] and m["short"]["var_0"] is None
    assert m["neg"]["_multiplicative"] is False and m["flat"]["break_at"] == []
    p = pw.predict_piecewise(df, pw.fit_piecewise(df, ["s"], holdout=6), ["s"])
    assert p.filter("yhat is null").count() == 0 or p.filter("yhat is null and s not in ('tiny')").count() == 0
    assert pw.fit_piecewise(df.limit(0), ["s"]).count() == 0
    off = pw.fit_piecewise(df.filter("s = 'gap'"), ["s"], n_breaks=0, origins=0).first()
    assert off["break_at"] == [] and off["var_0"] is None
    with pytest.raises(ValueError):
        pw.fit_piecewise(df, ["s"], prior=0)


def test_partitioning_does_not_change_the_sums(spark):
    r = np.random.default_rng(5)
    rows = [(s, _month(i), float(np.exp(r.normal()))) for s in range(3) for i in range(80)]
    df = spark.createDataFrame(rows, "s int, ds date, y double")
    one = sorted(map(tuple, pw.segment_gram(df.coalesce(1), ["s"], "ds", "y", [])[1].collect()))
    many = sorted(map(tuple, pw.segment_gram(df.repartition(7), ["s"], "ds", "y", [])[1].collect()))
    assert len(one) == len(many) and all(a[:3] == b[:3] for a, b in zip(one, many))
    assert np.allclose(np.array([x[3:] for x in one], float), np.array([x[3:] for x in many], float), atol=1e-6)
