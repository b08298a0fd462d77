"""Spine, resample and fills (D-26)."""

import datetime as dt

from finspark.operators import calendar as cal
from tests.conftest import rows


def _d(s):
    return dt.date.fromisoformat(s)


def test_spine_from_month_30th_reaches_month_ends(spark):
    df = spark.createDataFrame([("a", _d("2023-11-30")), ("a", _d("2024-03-15"))], "k string, ds date")
    got = [str(r["ds"]) for r in rows(cal.calendar_spine(df, ["k"], "ds"), ["ds"])]
    assert got == ["2023-11-30", "2023-12-31", "2024-01-31", "2024-02-29", "2024-03-31"]


def test_resample_sum_and_mean_with_gap_and_two_rows_in_month(spark):
    df = spark.createDataFrame([("a", _d("2024-01-05"), 1.0), ("a", _d("2024-01-20"), 2.0),
                                ("a", _d("2024-03-01"), 4.0)], "k string, ds date, v double")
    s = rows(cal.resample(df, ["k"], "ds", ["v"], how="sum"), ["ds"])
    assert [(str(r["ds"]), r["v"]) for r in s] == [("2024-01-31", 3.0), ("2024-02-29", 0.0), ("2024-03-31", 4.0)]
    m = rows(cal.resample(df, ["k"], "ds", ["v"], how="mean"), ["ds"])
    assert [r["v"] for r in m] == [1.5, None, 4.0]


def test_global_spine_keeps_leading_nulls_then_ffill(spark):
    df = spark.createDataFrame([("a", _d("2024-01-01"), 1.0), ("b", _d("2024-01-03"), 5.0)],
                               "k string, ds date, v double")
    r = cal.resample(df, ["k"], "ds", ["v"], how="mean", freq="day", bounds="global")
    f = rows(cal.fill_forward(r, ["k"], "ds", ["v"]), ["k", "ds"])
    assert [(x["k"], x["v"]) for x in f] == [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", None), ("b", None), ("b", 5.0)]


def test_fill_both_and_diff(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 3.0), ("a", 3, None), ("b", 1, None)],
                               "k string, t int, v double")
    f = rows(cal.fill_both(df, ["k"], "t", ["v"], 0.0), ["k", "t"])
    assert [x["v"] for x in f] == [3.0, 3.0, 3.0, 0.0]
    d = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 12.5), ("a", 3, None), ("a", 4, 1.0)], "k string, t int, x double")
    got = [x["dx"] for x in rows(cal.diff_prev(d, ["k"], "t", "x", "dx"), ["t"])]
    assert got == [0.0, 2.5, 0.0, 0.0]


def test_holdout_flag(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "k string, t int")
    got = rows(cal.holdout_flag(df, ["k"], "t", 3), ["t"])
    assert [x["is_holdout"] for x in got] == [False] * 7 + [True] * 3
