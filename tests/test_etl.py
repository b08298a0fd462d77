"""Upserts, surrogate keys and dimensional ETL (R-10..R-13, D-01..D-08)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from finspark.operators import dimensions as dim
from finspark.operators import upsert as ups
from finspark.sources import files
from tests.conftest import rows


def test_dense_index_is_contiguous_and_ordered(spark):
    df = spark.range(0, 5000).select(F.format_string("n%05d", (F.col("id") * 7919) % 5000).alias("name"))
    out = ups.dense_index(df, ["name"], "id", num_partitions=6)
    got = rows(out, ["id"])
    assert [r["id"] for r in got] == list(range(1, 5001))
    assert [r["name"] for r in got] == sorted(r["name"] for r in got)


def test_assign_keys_keeps_existing_ids(spark):
    existing = spark.createDataFrame([("b", 7)], "name string, id int")
    names = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "name string")
    got = {r["name"]: r["id"] for r in rows(ups.assign_keys(names, "name", existing))}
    assert got == {"b": 7, "a": 8, "c": 9}


def test_upsert_last_wins_idempotent_and_keeps_missing_columns(spark):
    tgt = spark.createDataFrame([(1, "old", 1.0, "keep")], "k int, v string, o double, extra string")
    batch = spark.createDataFrame([(1, "new1", 1.0), (1, "new2", 2.0), (2, "x", 0.0)], "k int, v string, o double")
    once = ups.upsert(tgt, batch, ["k"], ["o"])
    got = rows(once, ["k"])
    assert got == [{"k": 1, "v": "new2", "o": 2.0, "extra": "keep"}, {"k": 2, "v": "x", "o": 0.0, "extra": None}]
    twice = ups.upsert(once, batch, ["k"], ["o"])
    assert rows(twice, ["k"]) == got


def test_insert_new_first_wins_and_append(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "z"), (2, "q"), (2, "b")], "k int, v string")
    assert rows(ups.insert_new(tgt, batch, ["k"], ["v"]), ["k"]) == [{"k": 1, "v": "a"}, {"k": 2, "v": "b"}]
    assert ups.append(tgt, batch).count() == 4


def test_bridge_with_duplicates_and_unknown_names(spark):
    src = spark.createDataFrame([("P1", "A; B ;A"), ("P2", "C"), ("P9", "A")], "plant string, models string")
    plants = dim.load_dimension([spark.createDataFrame([("P1",), ("P2",)], "n string")])
    models = dim.load_dimension([spark.createDataFrame([("A",), ("B",)], "n string")])
    bridge, unknown = dim.load_bridge(src, "plant", "models", plants, models)
    assert sorted((r["left_id"], r["right_id"]) for r in bridge.collect()) == [(1, 1), (1, 2)]
    assert [(r["plant"], r["unknown_models"]) for r in unknown.collect()] == [("P2", "C")]


def test_load_fact_modes(spark):
    dept = dim.load_dimension([spark.createDataFrame([("Ops",), ("IT",)], "n string")])
    src = spark.createDataFrame([(dt.date(2024, 1, 31), "Ops", 1.0), (dt.date(2024, 1, 31), "Ops", 2.0),
                                 (dt.date(2024, 1, 31), "Nope", 3.0), (None, "IT", 4.0)],
                                "d date, department string, amount double")
    up = dim.load_fact(src, {"department": (dept, "department_id")}, required=["d"],
                       keys=["d", "department_id"], order_cols=["amount"], mode="upsert")
    assert [(r["department_id"], r["amount"]) for r in up.collect()] == [(2, 2.0)]
    ap = dim.load_fact(src, {"department": (dept, "department_id")}, required=["d"], mode="append")
    assert ap.count() == 2
    keep = dim.load_fact(src, {"department": (dept, "department_id")}, mode="append", keep_unmatched=["department"])
    assert keep.filter(F.col("department_id").isNull()).count() == 1


def test_profile_pivot_parse_goals_campaigns(spark):
    prof = spark.createDataFrame([("Acme", "Founded", "1999"), ("Acme", "Employees", "12000.0"),
                                  (None, "Founded", "2000")], "company string, attribute string, value string")
    p = dim.profile_pivot(prof, "company", "attribute", "value", ["Founded", "Employees", "HQ"],
                          int_attrs=["Founded", "Employees"]).first()
    assert (p["company"], p["Founded"], p["Employees"], p["HQ"]) == ("Acme", 1999, 12000, None)
    g = dim.parse_goals(spark.createDataFrame([("EV", "50% EV share by 2030"), ("Cost", None)],
                                              "goal string, description string"))
    assert [(r["goal_description"], r["target_year"]) for r in g.collect()] == [
        ("EV - 50% EV share by 2030", 2030), ("Cost", None)]
    c = dim.clean_campaigns(spark.createDataFrame([("5%", "6"), ("N/A", None), ("abc", "x")],
                                                  "sales_uplift_est string, duration_months string"))
    assert [(r["sales_uplift_est"], r["duration_months"]) for r in c.collect()] == [(0.05, 6), (None, None), (None, None)]


def test_load_statement_and_peer_merge(spark):
    src = spark.createDataFrame([("2024-01-31", 10.0, 1.0), ("2024-01-31", 11.0, 2.0)],
                                "`Statement Date` string, Revenue double, `Junk.Col` double")
    out = dim.load_statement(src, ["revenue"], key="statement_date", order_cols=["revenue"])
    assert [(str(r["statement_date"]), r["revenue"]) for r in out.collect()] == [("2024-01-31", 11.0)]
    # the first column is the date, whatever other columns are called
    two = spark.createDataFrame([("2024-01-31", "2020-05-05", 1.0)], "Month string, posting_date string, revenue double")
    assert str(dim.load_statement(two, ["revenue"]).first()["statement_date"]) == "2024-01-31"
    for bad in ("bad", None):
        df = spark.createDataFrame([(bad, 1.0)], "month string, revenue double")
        with pytest.raises(Exception, match="not a date"):
            dim.load_statement(df, ["revenue"]).collect()
    inc = spark.createDataFrame([(1, 2021, "1,000"), (1, 2022, "2,000")], "competitor_id int, fiscal_year int, `Total Revenue` string")
    bal = spark.createDataFrame([(1, 2022, "5"), (1, 2023, "6")], "competitor_id int, fiscal_year int, `Total Assets` string")
    m = rows(dim.merge_peer_financials(inc, bal, money_cols=["total_revenue", "total_assets"]), ["fiscal_year"])
    assert [(r["fiscal_year"], r["total_revenue"], r["total_assets"]) for r in m] == [
        (2021, 1000.0, None), (2022, 2000.0, 5.0), (2023, None, 6.0)]


def test_sources_pivot_and_transpose(spark, tmp_path):
    long = spark.createDataFrame([("CPIAUCSL", dt.date(2020, 1, 1), 1.0), ("TOTALSA", dt.date(2020, 1, 1), 2.0)],
                                 "series_id string, ds date, value double")
    w = files.pivot_series(long, {"CPIAUCSL": "cpi", "TOTALSA": "total_vehicle_sales"}).first()
    assert (w["cpi"], w["total_vehicle_sales"]) == (1.0, 2.0)
    st = spark.createDataFrame([("T", "Total Revenue", dt.date(2022, 12, 31), 5.0)],
                               "ticker string, item string, date date, value double")
    t = files.transpose_statement(st, ["Total Revenue", "Net Income"]).first()
    assert (t["fiscal_year"], t["Total Revenue"], t["Net Income"]) == (2022, 5.0, None)
    p = str(tmp_path / "x.csv")
    spark.createDataFrame([("1,5", "a")], "n string, s string").write.option("header", True).csv(p)
    r = files.read_csv_as_text(spark, p, ["n", "s"], numeric=["n"]).first()
    assert r["n"] is None and r["s"] == "a"


def test_write_table_partitioned_dynamic_overwrite(spark, tmp_path):
    p = str(tmp_path / "t")
    a = spark.createDataFrame([("base", 2, 1.0), ("base", 1, 2.0), ("alt", 1, 3.0)], "scenario string, m int, v double")
    files.write_table(a, p, partition_by=["scenario"], sort_within=["m"])
    files.write_table(spark.createDataFrame([("alt", 1, 9.0)], "scenario string, m int, v double"), p,
                      partition_by=["scenario"])
    got = sorted((r.scenario, r.m, r.v) for r in spark.read.parquet(p).collect())
    assert got == [("alt", 1, 9.0), ("base", 1, 2.0), ("base", 2, 1.0)]


def test_upsert_into_table_and_optional_source(spark, tmp_path):
    p = str(tmp_path / "facts")
    assert files.optional_source(spark, p) is None
    b1 = spark.createDataFrame([(1, "x", 1, 1.0), (2, "y", 1, 2.0)], "k int, part string, o int, v double")
    ups.upsert_into_table(b1, p, ["k"], ["o"], partition_by=["part"])
    b2 = spark.createDataFrame([(1, "x", 2, 5.0), (1, "x", 0, 9.0), (3, "x", 1, 3.0)], "k int, part string, o int, v double")
    ups.upsert_into_table(b2, p, ["k"], ["o"], partition_by=["part"])
    ups.upsert_into_table(b2, p, ["k"], ["o"], partition_by=["part"])  # idempotent re-run
    got = sorted((r.k, r.part, r.v) for r in files.optional_source(spark, p).collect())
    assert got == [(1, "x", 5.0), (2, "y", 2.0), (3, "x", 3.0)]


def test_upsert_keeps_other_rows_of_the_null_partition(spark, tmp_path):
    p = str(tmp_path / "facts")
    schema = "k int, p string, v double"
    ups.upsert_into_table(spark.createDataFrame([(1, None, 1.0), (2, None, 2.0), (3, "a", 3.0)], schema), p, ["k"], partition_by=["p"])
    ups.upsert_into_table(spark.createDataFrame([(1, None, 9.0)], schema), p, ["k"], partition_by=["p"])
    assert sorted((r.k, r.p, r.v) for r in spark.read.parquet(p).collect()) == [(1, None, 9.0), (2, None, 2.0), (3, "a", 3.0)]


def test_unpartitioned_upsert_swaps_a_staged_table(spark, tmp_path):
    p = str(tmp_path / "facts")
    for batch in ([(1, 1.0), (2, 2.0)], [(2, 5.0), (3, 3.0)], [(2, 5.0), (3, 3.0)]):
        ups.upsert_into_table(spark.createDataFrame(batch, "k int, v double"), p, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, 1.0), (2, 5.0), (3, 3.0)]
    assert [x.name for x in tmp_path.iterdir()] == ["facts"]


def test_only_a_missing_path_is_an_absent_source(spark, tmp_path):
    (tmp_path / "broken does not exist.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        files.optional_source(spark, str(tmp_path / "broken does not exist.parquet")).collect()
    assert files.optional_source(spark, str(tmp_path / "nowhere")) is None


def test_peers_from_raw_text(spark):
    inc = spark.createDataFrame([("a", "2021", "1,000", "x"), ("a", "n/a", "9", "x"), ("b", "2022", "NaN", "x")],
                                "Company string, Year string, `Total Revenue` string, Note string")
    bal = spark.createDataFrame([("a", "2021", "5"), ("a", "2023", ""), ("zz", "2021", "1")],
                                "Company string, Year string, `A.P` string")
    ids = spark.createDataFrame([("a", 1), ("b", 2)], "name string, id long")
    out = rows(dim.load_peers(inc, bal, ids), ["competitor_id", "fiscal_year"])
    assert [(r["competitor_id"], r["fiscal_year"], r["total_revenue"], r["accounts_payable"], r["inventory"]) for r in out] == [
        (1, 2021, 1000.0, 5.0, None), (1, 2023, None, None, None), (2, 2022, None, None, None)]
    again = dim.load_peers(spark.createDataFrame([("a", "2021", "7")], "company string, year string, total_revenue string"),
                           bal, ids, target=dim.load_peers(inc, bal, ids))
    assert {(r["competitor_id"], r["fiscal_year"]): r["total_revenue"] for r in again.collect()}[(1, 2021)] == 7.0
    with pytest.raises(ValueError, match="year"):
        dim.peer_measures(spark.createDataFrame([("a",)], "company string"))
