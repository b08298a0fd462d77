"""Ids and attributes kept in storage, and what uses them."""

import math

import pytest
from pyspark.sql import functions as F

from finspark.functions.expr import portable_noise
from finspark.operators import dimensions as dim
from finspark.operators import stored_ids as si


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _ids(df):
    return {r["name"]: r["id"] for r in df.collect()}


def test_batches_and_retries_give_dense_stable_ids(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert si.stored_ids(spark, path) is None
    assert _ids(si.register(_names(spark, "b", "a", None, "b"), path)) == {"a": 1, "b": 2}
    want = {"a": 1, "b": 2, "0": 3, "c": 4}
    assert _ids(si.register(_names(spark, "c", "a", "0"), path)) == want
    assert _ids(si.register(_names(spark, "c", "a", "0"), path)) == want  # again: nothing is added
    assert len(list((tmp_path / "ids").iterdir())) == 2


def test_a_batch_without_its_marker_does_not_count(spark, tmp_path):
    path = str(tmp_path / "ids")
    si.register(_names(spark, "a"), path)
    spark.createDataFrame([("x", 2), ("y", 3)], "name string, id long").write.parquet(f"{path}/batch-00000001")  # a run that died
    assert _ids(si.stored_ids(spark, path)) == {"a": 1}
    assert _ids(si.register(_names(spark, "y", "z"), path)) == {"a": 1, "y": 2, "z": 3}


def test_no_names(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert _ids(si.register(_names(spark, None), path)) == {}
    assert _ids(si.stored_ids(spark, path)) == {}


def test_attributes_are_upserted_with_their_ids(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = spark.createDataFrame([("a", "red", 1), ("a", "blue", 2), ("b", None, 1), (None, "x", 1)], "name string, colour string, seq int")
    got = si.load_stored_dimension([_names(spark, "a", "b", "c")], path, first, ["seq"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, "blue"), ("b", 2, None), ("c", 3, None)]
    second = spark.createDataFrame([("b", "green", 1), ("d", "black", 1)], "name string, colour string, seq int")
    for _ in range(2):
        got = si.load_stored_dimension([_names(spark, "c")], path, second, ["seq"])
        assert sorted(map(tuple, got.collect())) == [("a", 1, "blue"), ("b", 2, "green"), ("c", 3, None), ("d", 4, "black")]
    assert si.load_stored_dimension([_names(spark, "e")], path).count() == 5


def test_new_peers_get_ids_and_the_last_delivered_row_counts(spark, tmp_path):
    path = str(tmp_path / "companies")
    si.register(_names(spark, "old co"), path)
    inc = spark.createDataFrame([("old co", "2021", "900", 1), ("old co", "2021", "5", 2), ("a new co", "2021", "7", 1)],
                                "company string, year string, total_revenue string, seq int")
    bal = spark.createDataFrame([("a new co", "2022", "3", 1)], "company string, year string, inventory string, seq int")
    ids = si.register(dim.distinct_names([inc.select("company"), bal.select("company")]), path)
    out = dim.load_peers(inc, bal, ids, order_cols=["seq"])
    got = sorted((r["competitor_id"], r["fiscal_year"], r["total_revenue"], r["inventory"]) for r in out.collect())
    assert got == [(1, 2021, 5.0, None), (2, 2021, 7.0, None), (2, 2022, None, 3.0)]


def test_portable_noise_is_standard_stable_and_drawn_alike_elsewhere(spark):
    import duckdb

    from finspark.plans.oracle import _noise

    df = spark.range(20000).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("string")).alias("k"))
    z = df.select("id", portable_noise(3, "k", "id").alias("z"))
    a = z.agg(F.avg("z").alias("m"), F.stddev("z").alias("s"), F.skewness("z").alias("w"), F.max(F.abs("z")).alias("x")).first()
    assert abs(a.m) < 0.03 and abs(a.s - 1.0) < 0.03 and abs(a.w) < 0.06 and 3 < a.x < 6
    assert {r.id: r.z for r in z.repartition(7).collect()} == (got := {r.id: r.z for r in z.collect()})
    con = duckdb.connect()
    con.execute("create table t as select i as id, case when i % 7 > 0 then cast(i % 5 as varchar) end as k from range(20000) r(i)")
    assert dict(con.execute(f"select id, {_noise(3, 'k', 'id')} from t").fetchall()) == got
    other = df.select(portable_noise(4, "k", "id").alias("z")).limit(50).collect()
    assert all(math.isfinite(r.z) for r in other) and [r.z for r in other] != [got[i] for i in range(50)]


def test_paths_in_use_by_nothing_else(spark, tmp_path):
    with pytest.raises(Exception):
        si.register(_names(spark, "a").withColumnRenamed("name", "other"), str(tmp_path / "ids"))
