"""Distributed running sum == the single-task window, including a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from finspark.operators.windows import running_sum_before


def test_running_sum_before_matches_window(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("v"),
        F.format_string("n%05d", "id").alias("name"),
        (F.col("id") % 13).cast("decimal(18,2)").alias("amt"))
    order = [F.col("v").desc(), F.col("name").asc()]
    got = running_sum_before(df, ["g"], order, "amt", "before", num_chunks=9)
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("before", F.coalesce(F.sum("amt").over(w), F.lit(0).cast("decimal(18,2)")))
    a = sorted((r.name, r.before) for r in got.select("name", "before").collect())
    b = sorted((r.name, r.before) for r in exp.select("name", "before").collect())
    assert a == b and len(a) == 3000
