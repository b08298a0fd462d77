"""Stream of new rows upserted micro-batch by micro-batch == batch upsert."""

import os

from pyspark.sql import functions as F

from finspark.streaming import upsert_stream


def test_stream_upsert_matches_batch(spark, tmp_path):
    src, tgt, ck = (str(tmp_path / n) for n in ("src", "tgt", "ck"))
    schema = "k int, region string, v double, ts int"
    spark.createDataFrame([(1, "a", 1.0, 1), (2, "b", 2.0, 1)], schema).write.json(os.path.join(src, "b1"))
    q = upsert_stream(spark.readStream.schema(schema).json(src + "/*"), tgt, ["k"], ck,
                      order_cols=["ts"], partition_by=["region"])
    q.awaitTermination()
    spark.createDataFrame([(1, "a", 10.0, 2), (1, "a", 9.0, 1), (3, "a", 3.0, 1)], schema).write.json(
        os.path.join(src, "b2"))
    q = upsert_stream(spark.readStream.schema(schema).json(src + "/*"), tgt, ["k"], ck,
                      order_cols=["ts"], partition_by=["region"])
    q.awaitTermination()
    got = sorted((r.k, r.region, r.v) for r in spark.read.parquet(tgt).select("k", "region", "v").collect())
    assert got == [(1, "a", 10.0), (2, "b", 2.0), (3, "a", 3.0)]
    assert spark.read.parquet(tgt).filter(F.col("k") == 2).count() == 1
