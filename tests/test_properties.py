"""Property tests (hypothesis): allocation optimality conditions, upsert
idempotence and order independence, cash identities, N-way outer merge."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finspark.operators import allocate as al
from finspark.operators import cashflow as cf
from finspark.operators import joins
from finspark.operators import upsert as ups

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

money = st.integers(min_value=0, max_value=10_000).map(lambda c: c / 100.0)


@st.composite
def departments(draw):
    n = draw(st.integers(min_value=1, max_value=6))
    rows = []
    for i in range(n):
        req = draw(money)
        lo = draw(st.one_of(st.none(), money))
        hi = draw(st.one_of(st.none(), money))
        v = draw(st.integers(min_value=-2, max_value=5)) * 1.0
        rows.append((f"d{i}", req, lo, hi, v))
    cap = draw(st.integers(min_value=0, max_value=40_000)) / 100.0
    return rows, cap


@SETTINGS
@given(departments())
def test_allocation_is_feasible_and_greedy_optimal(spark, data):
    rows, cap = data
    depts = spark.createDataFrame(rows, "department string, requested_budget double, min_required double, "
                                        "max_plausible double, roi_score double").withColumns(
        {"efficiency_score": F.lit(0.0), "strategic_score": F.lit(0.0)})
    sc = spark.createDataFrame([("s", cap)], "scenario string, cap double")
    out = {r["department"]: r["optimized_allocation"] for r in al.allocate_budget(depts, sc).collect()}
    bounds = {}
    for name, req, lo, hi, v in rows:
        lo2 = lo if lo is not None else 0.0
        hi2 = hi if hi is not None else req * 1.5
        bounds[name] = (lo2, max(hi2, lo2), 0.5 * v)
    if sum(b[0] for b in bounds.values()) > cap + 1e-9:
        assert out == {}
        return
    assert set(out) == set(bounds)
    eps = 1e-6
    for name, x in out.items():
        lo, hi, _ = bounds[name]
        assert lo - eps <= x <= hi + eps
    assert sum(out.values()) <= cap + eps
    # optimality (exchange argument): no budget left while a positive-value
    # department is below its max, and no lower-value department above its
    # min while a higher-value one is below its max
    slack = cap - sum(out.values())
    for a, xa in out.items():
        la, ha, va = bounds[a]
        if va > 0 and xa < ha - eps:
            assert slack < eps
            for b, xb in out.items():
                lb, hb, vb = bounds[b]
                if vb < va:
                    assert xb <= lb + eps
        if va <= 0:
            assert abs(xa - la) < eps
    assert sum(1 for n, x in out.items() if bounds[n][0] + eps < x < bounds[n][1] - eps) <= 1 or \
        len({bounds[n][2] for n in out}) < len(out)


@st.composite
def batches(draw):
    n = draw(st.integers(min_value=1, max_value=25))
    return [(draw(st.integers(0, 5)), draw(st.integers(0, 3)), draw(st.integers(0, 100)) * 1.0) for _ in range(n)]


@SETTINGS
@given(batches(), batches())
def test_upsert_idempotent_and_equals_single_pass(spark, b1, b2):
    schema = "k int, o int, v double"
    d1, d2 = spark.createDataFrame(b1, schema), spark.createDataFrame(b2, schema)
    step = ups.upsert(ups.upsert(None, d1, ["k"], ["o"]), d2, ["k"], ["o"])
    again = ups.upsert(step, d2, ["k"], ["o"])
    got = sorted(map(tuple, step.collect()))
    assert got == sorted(map(tuple, again.collect()))
    # expected: keys of the second batch take its best row; others keep the first's
    best = {}
    for src in (b1, b2):
        cur = {}
        for k, o, v in src:
            if k not in cur or (o, v) > cur[k]:
                cur[k] = (o, v)
        best.update(cur)
    assert got == sorted((k, o, v) for k, (o, v) in best.items())
    shuffled = ups.upsert(ups.upsert(None, d1.repartition(3), ["k"], ["o"]), d2.repartition(4), ["k"], ["o"])
    assert sorted(map(tuple, shuffled.collect())) == got


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 12), money, money, money, money), min_size=1, max_size=12, unique_by=lambda t: t[0]))
def test_cash_identities_hold(spark, rows):
    inc = spark.createDataFrame([(dt.date(2024, m, 1), r, a, b, c) for m, r, a, b, c in rows],
                                "ds date, revenue double, cogs_materials double, operating_expenses double, taxes double")
    capex = spark.createDataFrame([(dt.date(2024, m, 15), c) for m, _, _, _, c in rows], "ds date, capex_outflow double")
    for r in cf.cash_flow_fact(inc, capex).collect():
        assert r["outflow_cogs"] == r["cogs_materials"]
        assert r["net_operating_cash_flow"] == r["revenue"] - (r["outflow_cogs"] + r["outflow_opex"] + 0.0 + r["taxes"])
        assert r["net_change_in_cash_total"] == r["net_operating_cash_flow"] - r["capex_outflow"] + 0.0
        assert r["outflow_opex"] in (r["operating_expenses"], r["revenue"] * 0.15)


@SETTINGS
@given(st.lists(st.integers(0, 9), unique=True), st.lists(st.integers(0, 9), unique=True),
       st.lists(st.integers(0, 9), unique=True))
def test_outer_merge_equals_chained_full_joins(spark, a, b, c):
    fa = spark.createDataFrame([(k, k * 1.0) for k in a], "k int, x double")
    fb = spark.createDataFrame([(k, k * 2.0) for k in b], "k int, y double")
    fc = spark.createDataFrame([(k, k * 3.0) for k in c], "k int, z double")
    got = sorted(map(tuple, joins.outer_merge([fa, fb, fc], ["k"]).select("k", "x", "y", "z").collect()))
    exp = sorted(map(tuple, fa.join(fb, "k", "full_outer").join(fc, "k", "full_outer").select("k", "x", "y", "z").collect()))
    assert got == exp
