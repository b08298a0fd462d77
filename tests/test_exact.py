"""Exact sums of doubles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from finspark.functions.exact import exact_mean, exact_sum


def _hard(r, n):
    out = [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-12, 14) for _ in range(n)]
    big = [r.choice([-1, 1]) * r.random() * 2.0 ** r.randint(60, 100) for _ in range(n // 4)]
    return out + big + [-x for x in big]  # what is left is far smaller than what cancels


def test_sums_are_those_of_exact_arithmetic_in_any_order(spark):
    r = random.Random(1)
    groups = {g: _hard(r, 200) for g in range(6)} | {10: [0.1] * 10, 11: [1e16, 1.0, -1e16], 12: [-0.1, -0.2, -0.3], 13: [0.0, -0.0],
                                                     14: [2.0 ** -96, -(2.0 ** -95)], 15: [5.0], 16: [-1e30, 1e30, 1e-20]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(20, None), (20, float("nan")), (21, None), (21, 3.5)]
    results = []
    for seed, parts in ((0, 1), (5, 7), (9, 16)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
        results.append({x.g: (x.s, x.m) for x in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()})
    assert results[0] == results[1] == results[2]
    for g, vs in groups.items():
        want = math.fsum(vs)
        got = results[0][g][0]
        assert abs(got - want) <= math.ulp(want) + len(vs) * 2.0 ** -97, (g, got, want)
    assert results[0][20] == (None, None) and results[0][21] == (3.5, 3.5)
    assert results[0][11][0] == 1.0 and results[0][16][0] == pytest.approx(1e-20, rel=1e-9)


def test_duckdb_writes_the_same_digits(spark):
    import duckdb

    from finspark.plans.oracle import _exact_mean, _exact_sum

    r = random.Random(3)
    rows = [(g, r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-6, 15)) for g in range(40) for _ in range(50)] + [(99, None)]
    con = duckdb.connect()
    con.execute("create table t (g int, v double)")
    con.executemany("insert into t values (?, ?)", rows)
    want = {g: (s, m) for g, s, m in con.execute(f"select g, {_exact_sum('v')}, {_exact_mean('v')} from t group by g").fetchall()}
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {x.g: (x.s, x.m) for x in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got == want


def test_nothing_is_collected_and_the_map_side_combines(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    plan = df.groupBy("g").agg(exact_sum("v").alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_sum" in plan and "ObjectHashAggregate" not in plan


def test_values_outside_the_range_are_refused(spark):
    for bad in (1e40, float("inf")):
        with pytest.raises(Exception, match="outside the exact range"):
            spark.createDataFrame([(bad,)], "v double").agg(exact_sum("v").alias("s")).collect()
    assert spark.createDataFrame([], "v double").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).first() == (None, None)
