"""Names resolved with hot names broadcast, ratios of home and peers in one
store, statements conformed to a stored table, and the model's backtest."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from finspark.operators import backtest, benchmarks, dimensions, joins, references, statements
from finspark.session import scratch_path
from finspark.sources import files

HOT = [("hot" if i % 3 == 0 else "lost" if i % 3 == 1 else None if i % 9 == 2 else f"n{i % 50}", i) for i in range(3000)]


@pytest.mark.parametrize("keep", [False, True])
def test_hot_names_equal_a_plain_lookup(spark, keep):
    df = spark.createDataFrame(HOT, "name_text string, id int").repartition(6)
    dim = spark.createDataFrame([("hot", 7), *[(f"n{i}", 100 + i) for i in range(40)]], "name string, id bigint")
    want = dimensions.lookup(df, dim, "name_text", "name", "id", "ref", keep).select("name_text", F.col("id").alias("i"), "ref")
    got = references.resolve_names(df, dim, "name_text", "ref", keep_unmatched=keep).select("name_text", F.col("id").alias("i"), "ref")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == (3000 if keep else want.count())


def test_rows_of_hot_names_are_not_shuffled(spark):
    """Neither the found hot name, the unknown hot name nor the missing names
    reach a shuffle, so no task gets more than a bounded share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(HOT, "name_text string, id int").repartition(6)
        dim = spark.createDataFrame([("hot", 7), *[(f"n{i}", 100 + i) for i in range(50)]], "name string, id bigint")
        out = references.resolve_names(df, dim, "name_text", "ref", keep_unmatched=True)
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) <= 600, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_names_of_an_empty_table(spark):
    df = spark.createDataFrame([], "name_text string, id int")
    dim = spark.createDataFrame([("hot", 7)], "name string, id bigint")
    assert references.resolve_names(df, dim, "name_text", "ref").columns == ["name_text", "id", "ref"]
    assert references.resolve_names(df, dim, "name_text", "ref", keep_unmatched=True).count() == 0


def _home(spark):
    inc = [("Home", dt.date(y, m, 28), 100.0 * (y - 2019), 10.0, 10.0, 10.0, 5.0, 1.0, 2.0) for y in (2020, 2021) for m in (1, 2)]
    bal = [("Home", dt.date(y, m, 28), 1000.0 + m, 300.0, 50.0, 25.0, 25.0, 40.0, 60.0, 10.0, 150.0, 400.0, 600.0, 20.0)
           for y in (2020, 2021) for m in (1, 2)]
    i = spark.createDataFrame(inc, "company_name string, ds date, revenue double, cogs_materials double, cogs_labor double, "
                              "cogs_overhead double, operating_expenses double, interest_expense double, taxes double")
    b = spark.createDataFrame(bal, "company_name string, balance_date date, total_assets double, total_current_assets double, "
                              "inventory_raw_materials double, inventory_wip double, inventory_finished_goods double, accounts_payable double, "
                              "long_term_debt double, short_term_debt double, total_current_liabilities double, total_liabilities double, "
                              "total_equity double, cash double")
    return benchmarks.home_statements(i, b)


def test_home_and_peers_in_one_store(spark):
    peers = spark.createDataFrame(
        [(1, 2020, 50.0, 5.0, 200.0, 80.0), (1, 2021, 75.0, 15.0, 250.0, 100.0), (2, 2021, 0.0, 4.0, 10.0, None), (9, 2021, 1.0, 1.0, 1.0, 1.0)],
        "competitor_id bigint, fiscal_year int, total_revenue double, net_income double, total_assets double, total_liabilities double")
    names = spark.createDataFrame([(1, "Peer"), (2, "Home")], "id bigint, name string")
    yearly = benchmarks.peer_statements(peers, names)
    ratios = benchmarks.company_ratios(_home(spark), yearly)
    path = scratch_path(spark, "ratios")
    for _ in range(2):  # a repeated run changes nothing
        benchmarks.store_ratios(ratios, path)
    kept = spark.read.parquet(path)
    got = {(r.company_name, r.fiscal_year, r.ratio_name): r.ratio_value for r in kept.collect()}
    assert len(got) == kept.count()
    assert got["Home", 2020, "Gross Profit Margin"] == (200.0 - 60.0) / 200.0
    assert got["Home", 2020, "Inventory Turnover"] == 60.0 / 100.0
    assert got["Home", 2021, "Revenue Growth YoY"] == 1.0
    # Equity of a peer that reports none: assets less liabilities, in all its years.
    assert got["Peer", 2021, "Return on Equity (ROE)"] == 15.0 / 150.0 and got["Peer", 2021, "Net Income Growth YoY"] == 2.0
    # A peer of the home company's name is no year before it and, coming later, replaces its ratio.
    assert got["Home", 2021, "Return on Assets (ROA)"] == 0.4 and got["Home", 2021, "Asset Turnover"] == 0.0
    assert ("Peer", 2020, "Revenue Growth YoY") not in got and not any(math.isnan(v) for v in got.values())


SCHEMA = "entity int, statement_date date, revenue double, head_count int, note string"


def _table(spark, path):
    spark.createDataFrame([(1, dt.date(2020, 1, 31), 5.0, 3, "kept"), (2, dt.date(2020, 1, 31), 6.0, 4, "old")], SCHEMA).write.parquet(path)


def test_statement_conformed_to_the_stored_table(spark):
    path = scratch_path(spark, "catalogue")
    _table(spark, path)
    sheet = spark.createDataFrame(
        [("1", "2020-01-31", " 1,250.5 ", "12", "x"), ("2", "2020-01-31", "", "9", None), ("3", "2020-02-29", "7", "many", "y"),
         (None, "2020-02-29", "7", "1", "y"), ("4", "soon", "7", "1", "y"), ("5", None, "7", "1", "y"), ("6", "2020-03-31", None, None, None)],
        "Entity string, `Statement Date` string, Revenue string, `Head Count` string, Region string")
    rejects = statements.load_into_catalogue(sheet, path, keys=["entity"], add_columns=True)
    assert sorted(r.reason for r in rejects.collect()) == [
        "entity: missing", "head_count: no int: many", "statement_date: missing", "statement_date: no date: soon"]
    want = [(1, dt.date(2020, 1, 31), 1250.5, 12, "kept", "x"), (2, dt.date(2020, 1, 31), None, 9, "old", None),
            (6, dt.date(2020, 3, 31), None, None, None, None)]
    for _ in range(2):
        back = spark.read.parquet(path)
        assert back.columns == ["entity", "statement_date", "revenue", "head_count", "note", "region"]
        assert sorted(map(tuple, back.collect())) == want
        statements.load_into_catalogue(sheet, path, keys=["entity"], add_columns=True)


def test_statement_without_wanted_columns(spark):
    path = scratch_path(spark, "catalogue")
    _table(spark, path)
    with pytest.raises(ValueError, match="keys"):
        statements.load_into_catalogue(spark.createDataFrame([("2020-01-31",)], "Date string"), path, keys=["entity"])
    with pytest.raises(ValueError, match="no date column"):
        statements.load_into_catalogue(spark.createDataFrame([("1",)], "Entity string"), path, keys=["entity"])
    with pytest.raises(ValueError, match="one name"):
        statements.load_into_catalogue(spark.createDataFrame([("1", "2", "2020-01-31")], "`A b` string, `A-b` string, Date string"), path)
    with pytest.raises(FileNotFoundError):
        statements.load_into_catalogue(spark.createDataFrame([("2020-01-31",)], "Date string"), path + "-none")
    # Columns that the table lacks are dropped unless asked for.
    out = statements.load_into_catalogue(spark.createDataFrame([(1, "2020-02-29", "z")], "entity int, Date string, Region string"), path, keys=["entity"])
    assert out.count() == 0 and spark.read.parquet(path).columns == ["entity", "statement_date", "revenue", "head_count", "note"]


def test_backtest_of_the_model(spark):
    """A known driver model is found, an unrelated truth is not, and history
    from the cutoff on has no part in the prediction."""
    months = [dt.date(y, m, 28) for y in range(2010, 2021) for m in range(1, 13)]
    rows, drivers = [], []
    for k, key in enumerate(("follows", "wanders")):
        for t, d in enumerate(months):
            x = math.sin(t * 0.7 + k) + 0.3 * math.cos(t * 1.9)
            drivers.append((key, d, x))
            rows.append((key, d, math.exp(6 + 0.02 * t / 12 + 0.1 * math.sin(2 * math.pi * d.month / 12) + 0.2 * x)))
    h = spark.createDataFrame(rows, "k string, ds date, y double")
    x = spark.createDataFrame(drivers, "k string, ds date, x double")
    truth = h.withColumn("y", F.when(F.col("k") == "wanders", F.col("y") * (2 + F.sin(F.month("ds") * 1.3))).otherwise(F.col("y")))
    verdicts, predicted = backtest.backtest_model(h, truth, x, ["k"], "2019-01-01", ["x"])
    got = {r.k: r for r in verdicts.collect()}
    assert got["follows"].n_test == 24 and got["follows"].mape < 0.02 and got["follows"].verdict == "EXCELLENT"
    assert got["wanders"].verdict == "VOLATILE"
    blind = h.withColumn("y", F.when(F.col("ds") < "2019-01-01", F.col("y")).otherwise(F.lit(1.0)))
    again = backtest.backtest_model(blind, truth, x, ["k"], "2019-01-01", ["x"])[1]
    assert sorted(map(tuple, predicted.select("k", "ds", "yhat").collect())) == sorted(map(tuple, again.select("k", "ds", "yhat").collect()))


def test_repeated_values_pivot_alike_in_any_order(spark):
    rows = [("a", "x", 3.0), ("a", "x", 1.0), ("a", "x", None), ("a", "y", 2.0), (None, "x", 9.0)]
    got = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, c string, v double").coalesce(1)
        got.append((dimensions.profile_pivot(df, "k", "c", "v", ["x", "y"]).collect(),
                    joins.outer_merge([df.filter("k is not null").select("k", "v"), df.select("k", "v").filter("v > 1")], ["k"]).orderBy("k").collect(),
                    files.pivot_series(df.withColumnRenamed("k", "ds"), {"x": "ex", "y": "ey"}, "c", "ds", "v").orderBy("ds").collect()))
    assert got[0] == got[1] and tuple(got[0][0][0]) == ("a", 1.0, 2.0)


def test_files_are_sorted_inside(spark, tmp_path):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k"), (F.col("id") % 3).cast("string").alias("part")).repartition(3)
    path = str(tmp_path / "out")
    for _ in range(2):  # dynamic overwrite: a second run replaces the same partitions
        files.write_table(df, path, "csv", partition_by=["part"], sort_within=["part", "k"])
    found = list((tmp_path / "out").glob("part=*/*.csv"))
    assert len(found) >= 3
    per = [[int(x) for x in f.read_text().split("\n")[1:] if x] for f in found]
    assert all(p == sorted(p) for p in per) and sum(map(len, per)) == 200
