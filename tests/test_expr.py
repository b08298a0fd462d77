"""Scalar expressions and the semantic gotchas G1, G4, G9, G10."""

import math

import pytest
from pyspark.sql import functions as F

from finspark.functions import expr as X
from finspark.functions import names as N


def test_nan_becomes_null_so_coalesce_fills(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "x double")
    out = df.select(F.coalesce(X.nan_to_null("x"), F.lit(0.0)).alias("y")).collect()
    assert sorted(r.y for r in out) == [0.0, 0.0, 2.0]
    # G1: in Spark NaN > 0 is true, after the conversion a missing value is not positive
    pos = df.select(F.when(X.nan_to_null("x") > 0, 1).otherwise(0).alias("p")).collect()
    assert sorted(r.p for r in pos) == [0, 0, 1]


def test_safe_div_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = [r.q for r in df.select(X.safe_div("a", "b").alias("q")).collect()]
    assert got == [None, None, None, 1.5]


def test_exact_sum_is_partition_invariant(spark):
    vals = [0.1 * i + 1e7 for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(X.dsum("x").alias("s")).first().s
    b = df.repartition(7).agg(X.dsum("x").alias("s")).first().s
    assert a == b


def test_money_and_percent_text(spark):
    df = spark.createDataFrame([("1,234.50",), ("  ",), ("abc",), (None,), (" 7 ",)], "t string")
    got = [r.v for r in df.select(X.money_text("t").alias("v")).collect()]
    assert got == [1234.5, None, None, None, 7.0]
    df = spark.createDataFrame([("5%",), ("N/A",), ("abc",), (None,), ("0.05",)], "t string")
    got = [r.v for r in df.select(X.percent_text("t").alias("v")).collect()]
    assert got[0] == 0.05 and got[1] is None and got[2] is None and got[3] is None
    assert abs(got[4] - 0.0005) < 1e-15  # a bare number is also divided by 100


def test_year_from_text(spark):
    df = spark.createDataFrame([("Grow EV share by 2030",), ("Cut costs",), ("by   2027 latest",)], "t string")
    assert [r.y for r in df.select(X.year_from_text("t").alias("y")).collect()] == [2030, None, 2027]


def test_split_trim_keeps_duplicates(spark):
    df = spark.createDataFrame([("A; B ;A",), ("",), (None,)], "t string")
    got = [r.a for r in df.select(X.split_trim("t").alias("a")).collect()]
    assert got[0] == ["A", "B", "A"] and got[1] == [] and got[2] is None


def test_alnum_and_unicode_value_cleaning(spark):
    df = spark.createDataFrame([("R&D Año (x)",)], "t string")
    r = df.select(X.alnum_only("t").alias("a"), X.clean_value_name("t").alias("c")).first()
    assert r.a == "RDAñox"
    assert r.c == "r_d_año_x"  # G10: (?U) keeps non-ASCII letters


def test_month_end_snaps(spark):
    df = spark.createDataFrame([("2024-02-10",), ("2023-02-28",), ("2021-01-31",)], "d string")
    got = [str(r.m) for r in df.select(X.month_end(F.col("d")).alias("m")).collect()]
    assert got == ["2024-02-29", "2023-02-28", "2021-01-31"]


def test_gaussian_noise_is_stable_and_standard(spark):
    df = spark.range(20000).select(F.col("id"), X.gaussian_noise(42, "id").alias("z"))
    a = df.agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(a.m) < 0.03 and abs(a.s - 1.0) < 0.03
    z1 = [r.z for r in df.repartition(3).orderBy("id").limit(5).collect()]
    z2 = [r.z for r in df.orderBy("id").limit(5).collect()]
    assert z1 == z2 and all(math.isfinite(v) for v in z1)


def test_column_name_cleaning_and_date_discovery(spark):
    assert N.standardise_name("  Total Revenue ($) ") == "total_revenue"
    assert N.standardise_financial_name("R&D Expense - Adj.") == "r&d_expense_adj"
    df = spark.createDataFrame([(1, "2020-01-31")], "a int, balance_date string")
    assert N.find_date_column(df) == "balance_date"
    df2 = spark.createDataFrame([(1,)], "a int")
    assert N.find_date_column(df2) is None
    out = N.ensure_columns(df2, {"b": "double"})
    assert out.columns == ["a", "b"] and out.first().b is None


def test_materialize_roundtrip_and_drop(spark):
    from finspark.session import drop_materialized, materialize
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "t")
    assert df.count() == 10 and df.columns == ["x"]
    drop_materialized(spark)


def test_nan_text_is_missing(spark):
    df = spark.createDataFrame([("NaN",), ("nan%",), ("3",)], "t string")
    for f, want in ((X.to_double_safe, [None, None, 3.0]), (X.money_text, [None, None, 3.0]), (X.percent_text, [None, None, 0.03])):
        assert [r.v for r in df.select(f("t").alias("v")).collect()] == want


def test_exact_sums_skip_nan_and_fail_beyond_their_range(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "x double")
    r = df.agg(X.dmean("x").alias("m"), X.dsum("x").alias("s")).first()
    assert (r.m, r.s) == (2.0, 2.0)
    for big in (1e16, float("inf"), -1e16):
        with pytest.raises(Exception, match="fixed-point range"):
            spark.createDataFrame([(big,)], "x double").agg(X.dsum("x")).collect()
