"""Distributed carries == the windows they replace."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from finspark.operators import calendar as cal
from finspark.operators.scans import carry

ALL = {"forward": {"f": "v"}, "backward": {"b": "v"}, "previous": {"p": "v"}, "following": {"n": "v"}}


def _rows():
    r = random.Random(1)
    key = lambda i: "hot" if i < 700 else r.choice(["a", "b", None, "only-nulls"])
    out = []
    for i in range(1000):
        k = key(i)
        gone = k == "only-nulls" or 200 <= i < 420 or r.random() < 0.4  # a run of nulls over several chunks
        out.append((k, (i * 7919) % 1009, None if gone else float(i), f"x{i}"))
    return out + [("lone", 1, 5.0, "y"), ("a", None, 1.0, "first")]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_carry_equals_window(spark, keys):
    df = spark.createDataFrame(_rows(), "k string, t int, v double, extra string").repartition(5)
    order = ["t", "extra"]
    up = Window.partitionBy(*keys).orderBy(*order)
    grow, shrink = up.rowsBetween(Window.unboundedPreceding, 0), up.rowsBetween(0, Window.unboundedFollowing)
    want = df.withColumns({"f": F.last("v", ignorenulls=True).over(grow), "b": F.first("v", ignorenulls=True).over(shrink),
                           "p": F.lag("v").over(up), "n": F.lead("v").over(up)})
    key = lambda x: str(tuple(x))
    for chunks in (1, 4, 37):
        got = carry(df, keys, order, **ALL, num_chunks=chunks)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key), chunks


def test_one_series_is_never_in_one_task(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).alias("v"))
    out = carry(df, [], ["id"], **ALL, num_chunks=8)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    # rows of the series are spread over the chunks
    per = out.groupBy(F.spark_partition_id()).count().collect()
    assert out.count() == 20_000 and max(x["count"] for x in per) < 20_000


def test_calendar_operators_use_it(spark):
    df = spark.createDataFrame([(3, None), (1, None), (2, 4.0), (4, 9.0), (5, None)], "t int, v double")
    get = lambda x, c="v": [r[c] for r in x.orderBy("t").collect()]
    assert get(cal.fill_forward(df, [], "t", ["v"])) == [None, 4.0, 4.0, 9.0, 9.0]
    assert get(cal.fill_backward(df, [], "t", ["v"])) == [4.0, 4.0, 9.0, 9.0, None]
    assert get(cal.fill_both(df, [], "t", ["v"])) == [4.0, 4.0, 4.0, 9.0, 9.0]
    assert get(cal.diff_prev(df.na.fill(1.0), [], "t", "v", "d"), "d") == [0.0, 3.0, -3.0, 8.0, -8.0]
    one = df.withColumn("k", F.lit("a"))
    assert get(cal.fill_both(one, ["k"], "t", ["v"], hot=True)) == get(cal.fill_both(one, ["k"], "t", ["v"]))
    assert cal.fill_forward(df.limit(0), [], "t", ["v"]).count() == 0
    assert get(cal.fill_both(df.filter("v is null"), [], "t", ["v"], 7.0)) == [7.0, 7.0, 7.0]


def test_wrong_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2.0)], "t int, v double")
    for bad in ({}, {"forward": {"a": "v"}, "backward": {"a": "v"}}, {"forward": {"t": "v"}}):
        with pytest.raises(ValueError):
            carry(df, [], ["t"], **bad)
