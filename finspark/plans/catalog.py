"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query composes the library operators over the adapters of
:mod:`finspark.sources.fixtures`, i.e. over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import alnum_only, money_text
from ..operators import allocate as alloc
from ..operators import backtest as bt
from ..operators import benchmarks as bench
from ..operators import calendar as cal
from ..operators import cashflow
from ..operators import dimensions as dim
from ..operators import drivers as drv
from ..operators import forecast as fc
from ..operators import history as hist
from ..operators import piecewise as pw
from ..operators import metrics as met
from ..operators import moves
from ..operators import ratios as rat
from ..operators import rollup as ru
from ..operators import scans, statements, stored_ids
from ..operators import upsert as ups
from ..operators.joins import outer_merge
from ..session import materialize, scratch_path
from ..sources import fixtures as fx
from ..sources import sheets as sh
from ..sources.files import clean_numeric, pivot_series, read_csv_as_text, read_table, transpose_statement, write_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def reg(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return reg


@query("cash_flow_fact")
def q_cash_flow_fact(spark, sf):
    """D-09 flagship: income + capex + debt + drivers per (nation, month)."""
    return _cash_flow_fact(fx.Monthly(spark, sf))


def _cash_flow_fact(m):
    return cashflow.cash_flow_fact(m.income(), legs=m.capex_and_debt(), indicators=m.drivers(), keys=["entity"], ds="ds", month_end=True)


@query("opex_sanity_patch")
def q_opex_sanity_patch(spark, sf):
    """D-10 at supplier-month grain (where the 1% floor actually fires)."""
    inc = fx.income(spark, sf, by="supplier")
    out = cashflow.impute_low_cost(inc, "operating_expenses", "revenue", 0.01, 0.15,
                                   raw_col="outflow_opex_raw", out="outflow_opex", flag_col="is_patched")
    return out.select("entity", "ds", "revenue", "outflow_opex_raw", "outflow_opex", "is_patched")


# ---------------------------------------------------------------- calendar

# Event types of the driver's events table (pivot columns).
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
DUP_KEYS = ("l_orderkey", "l_linenumber")
DUP_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


@query("resample_sum")
def q_resample_sum(spark, sf):
    """D-26 / R-41: capex per nation on each nation's full month spine, empty = 0."""
    return cal.resample(fx.capex(spark, sf), ["entity"], "ds", ["capex_outflow"], how="sum")


@query("resample_mean_ffill")
def q_resample_mean_ffill(spark, sf):
    """D-26 / R-42 + R-56: daily mean per user on the global day spine, then
    forward fill (users keep leading nulls before their first event)."""
    daily = cal.resample(fx.user_daily(spark, sf), ["entity"], "ds", ["value"], how="mean",
                         freq="day", bounds="global")
    return cal.fill_forward(daily, ["entity"], "ds", ["value"])


# ---------------------------------------------------------------- dimensional ETL
def _brand_dim(spark, sf):
    """All brands; the bridge text brings in the unknown names."""
    return dim.load_dimension([fx.table(spark, sf, "part").select("p_brand")])


def _supplier_dim(spark, sf):
    return dim.load_dimension([fx.table(spark, sf, "supplier").select("s_name")])


@query("dim_load")
def q_dim_load(spark, sf):
    """D-01: distinct part brands and types from two sources, ids by name."""
    p = fx.table(spark, sf, "part")
    return dim.load_dimension([p.select("p_brand"), p.select("p_type")])


def _supplier_brand_text(spark, sf):
    """Bridge source: one row per supplier, its part brands as '; '-joined
    text plus a padded repeat of the first brand (duplicates and blanks) and
    a misspelt one that no dimension has."""
    li = fx.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    p = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    pairs = li.join(p, "l_partkey").select("l_suppkey", "p_brand").distinct()
    # one list per supplier, bounded by the brand dimension (not by row count:
    # the pairs are already distinct)
    per = pairs.groupBy("l_suppkey").agg(F.sort_array(F.collect_set("p_brand")).alias("b"))
    wrong = F.concat(F.lit("Brandt#"), (F.col("l_suppkey") % 7).cast("string"))
    txt = F.concat(F.array_join("b", "; "), F.lit(" ; "), F.element_at("b", 1), F.lit(" ; "), wrong, F.lit(" ;"))
    return per.join(s, "l_suppkey").select("s_name", txt.alias("brands"))


@query("bridge_explode")
def q_bridge_explode(spark, sf):
    """D-02: supplier x brand bridge from list text; unknown brands dropped."""
    bridge, _unknown = dim.load_bridge(_supplier_brand_text(spark, sf), "s_name", "brands",
                                       _supplier_dim(spark, sf), _brand_dim(spark, sf),
                                       left_out="supplier_id", right_out="brand_id")
    return bridge


@query("bridge_unknown_names")
def q_bridge_unknown(spark, sf):
    """D-02 report: list items that have no dimension entry."""
    _bridge, unknown = dim.load_bridge(_supplier_brand_text(spark, sf), "s_name", "brands",
                                       _supplier_dim(spark, sf), _brand_dim(spark, sf))
    return unknown


@query("fact_append_fk")
def q_fact_append_fk(spark, sf):
    """D-03 append mode: lineitem rows keyed by part code and supplier name
    mapped to ids; rows whose code is misspelt (every line 7) are dropped."""
    p = fx.table(spark, sf, "part")
    part_dim = dim.load_dimension([p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")))])
    letter = F.when(F.col("l_linenumber") == 7, F.lit("Q")).otherwise(F.lit("P"))
    li = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(letter, F.col("l_partkey").cast("string")).alias("part_code"),
        "l_suppkey", "l_quantity", "l_extendedprice")
    src = li.join(fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"),
                  "l_suppkey")
    out = dim.load_fact(src, {"part_code": (part_dim, "part_id"),
                              "s_name": (_supplier_dim(spark, sf), "supplier_id")},
                        required=["part_id", "supplier_id"], mode="append")
    return out.select("l_orderkey", "l_linenumber", "part_id", "supplier_id", "l_quantity", "l_extendedprice")


@query("fact_hot_names")
def q_fact_hot_names(spark, sf):
    """R-34 / R-35 at scale: the first two lines of every order name one part
    and one supplier, so each name holds over a third of the rows; a supplier
    that no dimension has (line 3) and a missing one (line 4) keep a null id,
    misspelt parts (line 7) are dropped."""
    p = fx.table(spark, sf, "part")
    part_dim = dim.load_dimension([p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")))])
    sup = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    line = F.col("l_linenumber")
    li = fx.table(spark, sf, "lineitem").join(sup, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(line <= 2, F.lit("P1")).when(line == 7, F.lit("?")).otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("part"),
        F.when(line <= 2, F.lit("Supplier#000000001")).when(line == 3, F.lit("nobody")).when(line != 4, F.col("s_name")).alias("supplier"))
    out = dim.load_fact(li, {"part": (part_dim, "part_id"), "supplier": (_supplier_dim(spark, sf), "supplier_id")},
                        mode="append", keep_unmatched=["supplier"], hot_names=["part", "supplier"])
    return out.select("l_orderkey", "l_linenumber", "part_id", "supplier_id", "l_quantity")


@query("fact_load_upsert")
def q_fact_load_upsert(spark, sf):
    """D-03 upsert mode with an unmatched reference kept: two loads of the
    lineitems, one row per order and part code, the last by ship date and
    line; a supplier name that is misspelt (every line 7) keeps a null id."""
    p = fx.table(spark, sf, "part")
    part_dim = dim.load_dimension([p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")))])
    sup = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    name = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("?"), "s_name")).otherwise(F.col("s_name"))
    li = fx.table(spark, sf, "lineitem").join(sup, "l_suppkey").select(
        "l_orderkey", F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part_code"), name.alias("supplier"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_linenumber", "l_quantity")
    fks = {"part_code": (part_dim, "part_id"), "supplier": (_supplier_dim(spark, sf), "supplier_id")}
    args = {"required": ["part_id"], "keys": ["l_orderkey", "part_id"], "order_cols": ["l_shipdate", "l_linenumber"],
            "mode": "upsert", "keep_unmatched": ["supplier"]}
    first = dim.load_fact(li.filter(F.col("l_linenumber") <= 3), fks, **args)
    later = li.filter(F.col("l_linenumber") > 3)
    return dim.load_fact(later, fks, target=first, **args).select("l_orderkey", "part_id", "supplier_id", "l_shipdate", "l_linenumber",
                                                                  "l_quantity")


@query("dim_stored_batches")
def q_dim_stored_batches(spark, sf):
    """R-13 / D-01 in storage: brands of small parts with their count, then
    all brands and types with the brands' full count, then that load again:
    ids stay, new names follow, the count is the last one given."""
    p = fx.table(spark, sf, "part")
    path = scratch_path(spark, "part-names")
    count = lambda d: d.groupBy(F.col("p_brand").alias("name")).agg(F.count(F.lit(1)).alias("n_parts"))
    small = p.filter(F.col("p_size") < 25)
    stored_ids.load_stored_dimension([small.select("p_brand")], path, count(small))
    stored_ids.load_stored_dimension([p.select("p_brand"), p.select("p_type")], path, count(p))
    return stored_ids.load_stored_dimension([p.select("p_brand"), p.select("p_type")], path, count(p))


@query("fact_upsert_last_wins")
def q_fact_upsert_last_wins(spark, sf):
    """D-03 / D-07 / R-10: one row per (l_orderkey, l_linenumber), the last by
    (l_shipdate, l_partkey, l_suppkey, l_extendedprice, then the rest)."""
    return ups.upsert(None, fx.dup_facts(spark, sf), DUP_KEYS, DUP_ORDER)


@query("fact_upsert_first_wins")
def q_fact_upsert_first_wins(spark, sf):
    """R-11: insert-if-absent keeps the first row per key (ascending order)."""
    facts = fx.dup_facts(spark, sf)
    return ups.insert_new(facts.where(F.lit(False)), facts, DUP_KEYS, DUP_ORDER)


def _balances_and_batch(spark, sf):
    """Existing customers' balances, and a batch from all orders: order
    values for known customers and as many unknown ones, some of them null."""
    target = fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    o = fx.table(spark, sf, "orders")
    own = F.col("o_custkey").cast("bigint")
    batch = o.select(F.explode(F.array(own, own + F.lit(10_000_000_000))).alias("c_custkey"),
                     F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("c_acctbal"),
                     F.col("o_orderkey").alias("batch_seq"))
    return target.withColumn("c_custkey", F.col("c_custkey").cast("bigint")), batch


@query("upsert_into_existing")
def q_upsert_into_existing(spark, sf):
    """R-10 against data: the batch's last value (null included) replaces the
    balance, columns that the batch lacks keep theirs, new keys are added."""
    target, batch = _balances_and_batch(spark, sf)
    return ups.upsert(target, batch, ["c_custkey"], ["batch_seq"])


@query("insert_into_existing")
def q_insert_into_existing(spark, sf):
    """R-11 against data: existing rows stay, new keys take their first value."""
    target, batch = _balances_and_batch(spark, sf)
    batch = batch.withColumn("c_nationkey", F.lit(None).cast(target.schema["c_nationkey"].dataType))
    return ups.insert_new(target, batch, ["c_custkey"], ["batch_seq"])


@query("append_existing")
def q_append_existing(spark, sf):
    """R-12: every batch row after every existing row."""
    return ups.append(*_balances_and_batch(spark, sf))


@query("upsert_moved_keys")
def q_upsert_moved_keys(spark, sf):
    """R-10 with keys that change partition: all orders stored by status;
    every third one comes back with another status, some twice (the higher
    price wins), with new orders; a key is in one partition afterwards."""
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "orders-by-status")
    moves.upsert_moving(o, path, ["o_orderkey"], ["o_orderstatus"])
    shifted = F.translate("o_orderstatus", "FOP", "OPX")
    third = o.filter(F.col("o_orderkey") % 3 == 0)
    again = third.select("o_orderkey", (F.col("o_totalprice") + 1.0).alias("o_totalprice"), shifted.alias("o_orderstatus"))
    lower = third.filter(F.col("o_orderkey") % 2 == 0)
    new = o.select((F.col("o_orderkey") + F.lit(10_000_000_000)).alias("o_orderkey"), "o_totalprice", F.lit("N").alias("o_orderstatus"))
    moves.upsert_moving(again.unionByName(lower).unionByName(new), path, ["o_orderkey"], ["o_orderstatus"], ["o_totalprice"])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("unmatched_refs")
def q_unmatched_refs(spark, sf):
    """R-36: orders with no lineitem."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              F.col("o_orderdate").cast("date").alias("o_orderdate"))
    li = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return dim.unmatched(o, li.withColumn("name", F.col("o_orderkey")), "o_orderkey", "name")


@query("profile_pivot")
def q_profile_pivot(spark, sf):
    """D-04 / R-48: user x event_type -> one column of sums per listed type."""
    e = fx.table(spark, sf, "events").select("user_id", "event_type", "value")
    return dim.profile_pivot(e, "user_id", "event_type", "value", EVENT_TYPES, agg="sum")


@query("goal_year_extract")
def q_goal_year_extract(spark, sf):
    """D-05: goal text per order; pending orders carry no 'by YYYY'."""
    o = fx.table(spark, sf, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Improve "), F.col("o_orderpriority"))) \
        .otherwise(F.concat(F.lit("Target "), F.col("o_orderpriority"), F.lit(" by "),
                            F.year("o_orderdate").cast("string")))
    g = o.select("o_orderkey", F.col("o_orderpriority").alias("goal"), txt.alias("description"))
    return dim.parse_goals(g).select("o_orderkey", "goal_description", "target_year")


@query("percent_text_clean")
def q_percent_text_clean(spark, sf):
    """D-06: '7%' / 'N/A' / 'abc' / null uplift text -> fraction; int duration."""
    li = fx.table(spark, sf, "lineitem")
    pct = F.concat(F.round(F.col("l_discount") * F.lit(100.0)).cast("bigint").cast("string"), F.lit("%"))
    txt = (F.when(F.col("l_discount") == 0, F.lit("N/A"))
           .when(F.col("l_linenumber") == 7, F.lit("abc"))
           .when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
           .otherwise(pct))
    src = li.select("l_orderkey", "l_linenumber", txt.alias("uplift_text"),
                    txt.alias("sales_uplift_est"), F.col("l_quantity").alias("duration_months"))
    return dim.clean_campaigns(src)


@query("money_text_clean")
def q_money_text_clean(spark, sf):
    """R-72: '12,345.67' text -> double; blank and junk -> null."""
    o = fx.table(spark, sf, "orders")
    txt = F.expr("""case when o_orderstatus = 'P' then '  '
                         when o_orderpriority = '5-LOW' then 'n/a'
                         else concat(cast(cast(round(o_totalprice * 100) as bigint) div 100000 as string), ',',
                                     lpad(cast((cast(round(o_totalprice * 100) as bigint) div 100) % 1000 as string), 3, '0'),
                                     '.', lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as string), 2, '0'))
                    end""")
    return o.select("o_orderkey", txt.alias("money_text")).withColumn("amount", money_text("money_text"))


@query("latest_per_group")
def q_latest_per_group(spark, sf):
    """R-43: the latest order of each customer (tie-break: higher order key),
    as an aggregate (``max_by``) rather than a sorted window."""
    o = fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"),
                                              "o_totalprice")
    last = o.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderdate", "o_totalprice"),
                                                F.struct("o_orderdate", "o_orderkey")).alias("r"))
    return last.select("o_custkey", "r.o_orderkey", "r.o_orderdate", "r.o_totalprice")


@query("nway_outer")
def q_nway_outer(spark, sf):
    """R-33: three monthly component tables full-outer joined on (entity, ds)
    as one union + group (one shuffle instead of two joins)."""
    m = fx.Monthly(spark, sf)
    inc, cx = m.income().select("entity", "ds", "revenue"), m.capex()
    db = m.debt().select("entity", "ds", "long_term_debt")
    return outer_merge([inc, cx, db], ["entity", "ds"])


def _also_in(df, year, other):
    """Every row, and the rows of ``year`` again as rows of ``other``."""
    years = F.when(F.col("fiscal_year") == year, F.array(F.col("fiscal_year"), F.lit(other).cast("int"))).otherwise(
        F.array("fiscal_year"))
    return df.withColumn("fiscal_year", F.explode(years)).select(*df.columns)


@query("peer_statement_merge")
def q_peer_statement_merge(spark, sf):
    """D-08: all supplier income-years full outer join all balance-years,
    upserted on (competitor_id, fiscal_year). Each side also brings years
    that the other lacks: income restated for 2010, balances for 2011."""
    inc = fx.income(spark, sf, by="supplier", period="year").withColumnRenamed("entity", "competitor_id")
    inc = _also_in(inc, 1997, 2010)
    sup = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("competitor_id"),
                                                  F.col("s_nationkey").cast("bigint").alias("nation"))
    bal = _also_in(fx.balance_year_end(spark, sf).join(sup, "nation").drop("nation"), 1995, 2011)
    return dim.merge_peer_financials(inc, bal, ["competitor_id"], "fiscal_year")


@query("peer_load")
def q_peer_load(spark, sf):
    """D-08 from raw statements: text with thousands marks under delivered
    names, an extra note, rows whose year is no number, ids by company name."""
    return dim.load_peers(*_peer_statements(spark, sf), _supplier_dim(spark, sf))


def _peer_statements(spark, sf, more=False):
    """Income and balance of every supplier as delivered text, with ``more``
    measures by choice."""
    sup = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("entity"), "s_name", "s_nationkey")

    def text(c):
        return F.format_number(F.floor(c).cast("bigint"), 0)

    def also_undated(df):  # every row, and 1996 again without a usable year
        years = F.when(F.col("fiscal_year") == 1996, F.array(F.lit("1996"), F.lit("n/a"))).otherwise(
            F.array(F.col("fiscal_year").cast("string")))
        return df.withColumn("Year", F.explode(years))

    profit = [text(F.col("revenue") - F.col("cogs_materials")).alias("Gross Profit"),
              text(F.col("revenue") - F.col("operating_expenses")).alias("Operating Income"),
              text(F.col("revenue") - F.col("taxes")).alias("Net Income")] if more else []
    stock = [text("inventory_raw_materials").alias("Inventory")] if more else []
    inc = also_undated(fx.income(spark, sf, by="supplier", period="year").join(sup, "entity")).select(
        F.col("s_name").alias("Company"), "Year", text("revenue").alias("Total Revenue"),
        text("cogs_materials").alias("Cost of Revenue"), text("interest_expense").alias("Interest-Expense"),
        F.lit("audited").alias("Note"), *profit)
    bal = fx.balance_year_end(spark, sf)
    bal = also_undated(bal.join(sup, bal.nation == sup.s_nationkey)).select(
        F.col("s_name").alias("Company"), "Year", text("total_assets").alias("Total Assets"),
        text("accounts_payable").alias("A.P."), text("long_term_debt").alias("Long-Term Debt"), *stock)
    return inc, bal


@query("peer_load_new_companies")
def q_peer_load_new_companies(spark, sf):
    """D-08 with companies that have no id yet: a first delivery names every
    third supplier, the second one all, with corrected revenue delivered
    after the first figure; unknown companies get ids after the known ones."""
    inc, bal = (materialize(d.toDF(*[c.replace(" ", "_").replace(".", "_") for c in d.columns]), "delivery")
                for d in _peer_statements(spark, sf))
    third = F.col("Company").substr(-1, 1).isin("3", "6", "9")
    path = scratch_path(spark, "companies")
    revised = inc.withColumn("Seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "Total_Revenue", F.when(F.col("Seq") == 1, F.lit("9,999,999,999,999")).otherwise(F.col("Total_Revenue")))
    out = None
    for part in (lambda d: d.filter(third), lambda d: d):
        i, b = part(revised), part(bal).withColumn("Seq", F.lit(1))
        ids = stored_ids.register(dim.distinct_names([i.select("Company"), b.select("Company")]), path)
        out = dim.load_peers(i, b, ids, target=out, order_cols=["seq"])
    return out.join(ids.withColumnRenamed("id", "competitor_id"), "competitor_id").select(
        F.col("name").alias("company"), "competitor_id", "fiscal_year", "total_revenue", "interest_expense", "total_assets",
        "long_term_debt")


# ---------------------------------------------------------------- benchmark ratios


def _annual(spark, sf):
    """D-20 per supplier: yearly income sums + its nation's year-end balance
    (latest month-end row of the year)."""
    inc = rat.annual_income(fx.income(spark, sf, by="supplier"), ["entity"], "ds")
    bal = rat.year_end_balance(fx.balance_monthly(spark, sf), ["nation"], "balance_date")
    bal = bal.join(fx.supplier_nation(spark, sf), "nation").drop("nation")
    keep = [c for c in rat.BALANCE_COLUMNS if c in bal.columns]
    return inc.join(bal.select("entity", "fiscal_year", *keep), ["entity", "fiscal_year"], "inner")


@query("annual_statements")
def q_annual_statements(spark, sf):
    return _annual(spark, sf)


@query("financial_ratios")
def q_financial_ratios(spark, sf):
    """D-21: the 12 level ratios per (supplier, year), long, nulls dropped."""
    return rat.financial_ratios(_annual(spark, sf), ["entity"], include="level")


@query("growth_yoy")
def q_growth_yoy(spark, sf):
    """D-21: revenue and net-income growth against the previous row."""
    return rat.financial_ratios(_annual(spark, sf), ["entity"], include="growth")


@query("company_ratios")
def q_company_ratios(spark, sf):
    """D-20 .. D-22 in one keyed store: the nations as home companies from
    monthly tables, the suppliers as peers from delivered text. A draft of
    the home ratios (revenue doubled) is stored first and then replaced."""
    n = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("entity"), F.col("n_name").alias("company_name"))
    inc = materialize(fx.income(spark, sf, by="nation").join(F.broadcast(n), "entity").drop("entity"), "home_income")
    bal = materialize(fx.balance_monthly(spark, sf).withColumnRenamed("nation", "entity").join(F.broadcast(n), "entity").drop("entity"),
                      "home_balance")
    home = bench.home_statements(inc, bal)
    companies = materialize(_supplier_dim(spark, sf), "companies")
    peers = bench.peer_statements(materialize(dim.load_peers(*_peer_statements(spark, sf, more=True), companies), "peers"), companies)
    path = scratch_path(spark, "company_ratios")
    draft = bench.home_statements(inc.withColumn("revenue", F.col("revenue") * 2), bal)
    bench.store_ratios(bench.company_ratios(draft, peers.limit(0)), path)
    bench.store_ratios(bench.company_ratios(home, peers), path)
    return spark.read.parquet(path).select("company_name", "fiscal_year", "ratio_category", "ratio_name", "ratio_value")


@query("derive_equity")
def q_derive_equity(spark, sf):
    """D-22: nations of regions 0 and 2 lose equity in every year (derived
    back from assets - liabilities); nation 1 loses it in 1998 only (kept null)."""
    bal = rat.year_end_balance(fx.balance_monthly(spark, sf), ["nation"], "balance_date")
    n = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("nation"), "n_regionkey")
    bal = bal.join(n, "nation").withColumn(
        "total_equity",
        F.when(F.col("n_regionkey").isin(0, 2) | ((F.col("nation") == 1) & (F.col("fiscal_year") == 1998)),
               F.lit(None).cast("double")).otherwise(F.col("total_equity")))
    out = rat.derive_equity(bal, ["nation"])
    return out.select("nation", "fiscal_year", "total_assets", "total_liabilities", "total_equity")


# ---------------------------------------------------------------- budget allocation
# Scenario caps as shares of the total requested budget; 0.5 is below the sum
# of minimums (0.7 x requested for most departments), so it is infeasible.
ALLOC_SCENARIOS = (("full", "1.0"), ("tight", "0.8"), ("infeasible", "0.5"))


def _allocation(spark, sf):
    d = fx.depts(spark, sf)
    total = d.agg(F.sum("requested_budget").alias("t")).select("t").scalar()
    sc = spark.createDataFrame(list(ALLOC_SCENARIOS), "scenario string, f string").select(
        "scenario", (F.col("f").cast("decimal(2,1)") * total).alias("cap"))
    return alloc.allocate_budget(d, sc)


@query("budget_allocation")
def q_budget_allocation(spark, sf):
    """D-23: greedy-by-value allocation under each scenario cap."""
    return _allocation(spark, sf)


@query("budget_pivot")
def q_budget_pivot(spark, sf):
    """D-23 + R-48: allocation per department, one column per scenario."""
    return alloc.allocation_pivot(_allocation(spark, sf), ["full", "tight"])


# ---------------------------------------------------------------- driver scenarios and history

# Scenario definitions on the fixture calendar (1995-2001): the reference
# tariff shock moved into the data's range, plus a second scenario.
SHOCK_WINDOWS = {
    "tariff": (drv.TARIFF_SHOCKS, "1998-03-01", "1999-06-30"),
    "recession": ((("economic_activity_index", -0.05), ("interest_rate_proxy", 0.10)), "2000-01-01", "2000-12-31"),
}


def _shocks(spark):
    out = None
    for name, (sh, a, b) in SHOCK_WINDOWS.items():
        t = drv.shock_table(spark, name, sh, a, b)
        out = t if out is None else out.unionByName(t)
    return out


@query("driver_shock")
def q_driver_shock(spark, sf):
    """D-11: drivers shocked for two scenarios in one job."""
    return drv.shock_drivers(fx.drivers(spark, sf), _shocks(spark))


@query("scenario_overlay")
def q_scenario_overlay(spark, sf):
    """D-12: base drivers, shocked values inside 1998-01-31..1999-06-30."""
    base = fx.Monthly(spark, sf).drivers()
    alt = drv.shock_drivers(base, drv.shock_table(spark, "alt", drv.TARIFF_SHOCKS, "1995-01-01", "2001-12-31"))
    alt = alt.drop("scenario")
    return drv.overlay_window(base, alt, "1998-01-31", "1999-06-30")


@query("history_splice")
def q_history_splice(spark, sf):
    """D-13: order-value history, dated three years back, before each
    nation's first shipped-revenue month, then all actuals."""
    return _spliced(fx.Monthly(spark, sf))


def _spliced(m):
    older = m.order_revenue().withColumn("ds", F.last_day(F.add_months("ds", -36)))
    return drv.splice_history(older, m.income().select("entity", "ds", "revenue"), ["entity"])


def _calibration(m):
    return hist.calibrate(_income_components(m), ["entity"], "ds", n=12)


@query("calibration_stats")
def q_calibration_stats(spark, sf):
    """D-24: first 12 months of each nation's cash-flow fact."""
    return _calibration(fx.Monthly(spark, sf))


@query("synthetic_history")
def q_synthetic_history(spark, sf):
    """D-25: per-nation drivers as the macro series (order count = vehicle
    sales, unit price = CPI), calibrated on the nation's actuals, noise 0."""
    return _synthetic(spark, sf, 0.0)


@query("synthetic_history_noise")
def q_synthetic_history_noise(spark, sf):
    """D-25 / R-82: the same with 2 % noise, drawn alike by every engine."""
    return _synthetic(spark, sf, hist.NOISE_STD).select("entity", "ds", "inflow_operating_revenue", "outflow_cogs", "outflow_opex")


def _synthetic(spark, sf, noise):
    m = fx.Monthly(spark, sf)
    macro = m.drivers_by_nation().withColumnsRenamed(
        {"economic_activity_index": "total_vehicle_sales"}).withColumn("cpi", F.col("ev_component_cost_index"))
    return hist.synthetic_history(macro, _calibration(m), ["entity"], "ds", noise_std=noise,
                                  passthrough=["interest_rate_proxy", "consumer_confidence_index"])


# ---------------------------------------------------------------- metrics, backtest, roll-up

COMPONENTS = ("inflow_operating_revenue", "outflow_cogs", "outflow_opex")
ACTUALS_END = "2000-12-31"
BACKTEST_CUTOFF = "2000-01-01"
ELASTICITY_SHOCKS = (("economic_activity_index", -0.05), ("consumer_confidence_index", -0.15))
ELASTICITY_WINDOW = ("2000-06-01", "2001-06-30")


def _prior_year(df, keys, value, out):
    """Seasonal-naive forecast: the value of the same month one year earlier."""
    return df.select(*keys, F.last_day(F.add_months("ds", 12)).alias("ds"), F.col(value).alias(out))


def _fact(m):
    """The monthly fact materialised once in the shared checkpoint folder:
    queries below consume it in several branches, which would otherwise each
    re-scan the raw tables."""
    return materialize(_cash_flow_fact(m), "cash_flow_fact")


def _income_components(m):
    """The fact's revenue / cogs / opex legs depend on the income table only:
    the fact operator without capex, debt or drivers yields them (identical
    values) without the extra scans and joins."""
    return cashflow.cash_flow_fact(m.income(), keys=["entity"], ds="ds", month_end=True)


def _components_long(spark, sf):
    fact = materialize(_income_components(fx.Monthly(spark, sf)), "components")
    arr = F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("y")) for c in COMPONENTS])
    long = fact.select("entity", "ds", F.explode(arr).alias("_c")).select("entity", "_c.component", "ds", "_c.y")
    return long.join(_prior_year(long, ["entity", "component"], "y", "yhat"), ["entity", "component", "ds"], "left")


@query("holdout_metrics")
def q_holdout_metrics(spark, sf):
    """D-15: last 6 months of each (nation, component) vs the seasonal-naive forecast."""
    return met.holdout_metrics(_components_long(spark, sf), ["entity", "component"], n=6)


@query("backtest_verdict")
def q_backtest_verdict(spark, sf):
    """D-16: blind backtest from 2000-01-01; prediction = the same calendar
    month of the last training year; MAPE fraction and verdict band."""
    inc = fx.Monthly(spark, sf).income().select("entity", "ds", F.col("revenue").alias("y"))
    cut = F.lit(BACKTEST_CUTOFF).cast("date")
    train12 = inc.filter((F.col("ds") < cut) & (F.col("ds") >= F.add_months(cut, -12))).select(
        "entity", F.month("ds").alias("_moy"), F.col("y").alias("yhat"))
    scored = inc.withColumn("_moy", F.month("ds")).join(train12, ["entity", "_moy"], "left")
    return met.backtest(scored, ["entity"], BACKTEST_CUTOFF)


@query("backtest_rescaled_truth")
def q_backtest_rescaled_truth(spark, sf):
    """D-16 against the market: the truth is each nation's order count scaled
    so that its last 12 months before 2000 average the fixed revenue scale;
    the prediction is the truth of the same month a year earlier."""
    market = materialize(fx.drivers_by_nation(spark, sf).select("entity", "ds", F.col("economic_activity_index").alias("sales")), "market")
    truth = met.scaled_truth(market, ["entity"], "sales", hist.FALLBACK_REVENUE, BACKTEST_CUTOFF)
    scored = truth.join(_prior_year(truth, ["entity"], "y", "yhat"), ["entity", "ds"], "left")
    return met.backtest(scored, ["entity"], BACKTEST_CUTOFF)


@query("backtest_model")
def q_backtest_model(spark, sf):
    """D-16 with the model: fitted on each nation's revenue before 2000 (on
    the fixed scale), predicted with the drivers as they were, and scored
    against the market (order count) on the same scale."""
    m = fx.Monthly(spark, sf)
    drivers = materialize(m.drivers_by_nation(), "drivers")
    history = met.scaled_truth(m.income().select("entity", "ds", "revenue"), ["entity"], "revenue", hist.FALLBACK_REVENUE, BACKTEST_CUTOFF)
    truth = met.scaled_truth(drivers, ["entity"], "economic_activity_index", hist.FALLBACK_REVENUE, BACKTEST_CUTOFF)
    # The market itself is no driver of its own prediction.
    return bt.backtest_model(history, truth, drivers, ["entity"], BACKTEST_CUTOFF, DRIVERS[1:])[0]


def _components_wide(fact):
    """Actuals hidden after 2000-12; forecast = same month of the prior year."""
    cols = {}
    for c in COMPONENTS:
        cols[f"{c}_actual"] = F.when(F.col("ds") <= F.lit(ACTUALS_END).cast("date"), F.col(c))
    comp = fact.select("entity", "ds", *[v.alias(k) for k, v in cols.items()])
    prev = fact.select("entity", F.last_day(F.add_months("ds", 12)).alias("ds"),
                       *[F.col(c).alias(f"{c}_forecast") for c in COMPONENTS])
    return comp.join(prev, ["entity", "ds"], "left")


def _hist(fact):
    return fact.filter(F.col("ds") <= F.lit(ACTUALS_END).cast("date")).select(
        "entity", "ds", "interest_expense", "taxes", "long_term_debt", "net_debt_financing_activity", "capex_outflow")


@query("net_cash_rollup")
def q_net_cash_rollup(spark, sf):
    """D-17 (forecast-start path): components + history + full capex -> cash flow."""
    m = fx.Monthly(spark, sf)
    fact = _fact(m)
    return ru.net_cash_rollup(_components_wide(fact), _hist(fact), m.capex(),
                              ["entity"], mode="forecast_start")


def _elasticity(spark, m, fact):
    base = m.drivers()
    alt = drv.shock_drivers(base, drv.shock_table(spark, "alt", ELASTICITY_SHOCKS, *ELASTICITY_WINDOW)).drop("scenario")
    return ru.elasticity_overlay(_components_wide(fact), base, alt, ["entity"])


@query("elasticity_overlay")
def q_elasticity_overlay(spark, sf):
    """D-18: revenue forecasts scaled by driver changes where actuals are missing."""
    m = fx.Monthly(spark, sf)
    return _elasticity(spark, m, _fact(m)).select("entity", "ds", *[f"{c}_final" for c in COMPONENTS],
                                         "activity_pct_delta", "confidence_pct_delta", "cost_pct_delta")


@query("scenario_comparison")
def q_scenario_comparison(spark, sf):
    """D-19: base vs elasticity scenario net cash (projection-everywhere path)."""
    m = fx.Monthly(spark, sf)
    fact = _fact(m)
    hist = _hist(fact)
    base = ru.net_cash_rollup(_components_wide(fact), hist, keys=["entity"], mode="everywhere")
    alt = ru.net_cash_rollup(_elasticity(spark, m, fact), hist, keys=["entity"], mode="everywhere")
    return ru.compare_scenarios(base, alt, keys=["entity"], window=ELASTICITY_WINDOW)


# ---------------------------------------------------------------- forecasting

DRIVERS = ("economic_activity_index", "consumer_confidence_index", "interest_rate_proxy", "ev_component_cost_index")


def _forecast_input(m):
    """Long components per nation joined with the nation's drivers,
    materialised (fit and prediction read it in several branches)."""
    fact = _income_components(m).select("entity", "ds", *COMPONENTS)
    arr = F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("y")) for c in COMPONENTS])
    long = fact.select("entity", "ds", F.explode(arr).alias("_c")).select("entity", "_c.component", "ds", "_c.y")
    return materialize(long.join(m.drivers_by_nation(), ["entity", "ds"], "left"), "forecast_input")


@query("forecast_trend")
def q_forecast_trend(spark, sf):
    """D-14 trend term: least-squares revenue trend per nation on the month
    index (months since 1995-01), from exact sums."""
    inc = fx.income(spark, sf, by="nation").withColumn(
        "t", F.year("ds") * 12 + F.month("ds") - F.lit(1995 * 12 + 1))
    return fc.linear_trend(inc, ["entity"], "t", "revenue")


@query("forecast_gram")
def q_forecast_gram(spark, sf):
    """D-14 fit statistics: the exact Gram aggregate of every model's design
    (trend, 3 seasonal pairs, 4 standardised drivers) per nation and component."""
    return _gram_of(_forecast_input(fx.Monthly(spark, sf)))


def _gram_of(df):
    keys = ["entity", "component"]
    obs = df.filter(F.col("y").isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.col("ds").desc())
    train = obs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > 6).drop("_rn")
    stats = fc.series_stats(train, keys, "ds", "y", DRIVERS)
    x = fc.design(train, stats, keys, "ds", DRIVERS).withColumn("_t", fc.target_expr("y"))
    return fc.gram(x, keys, fc.feature_names(3, DRIVERS))


@query("forecast_fit_check")
def q_forecast_fit_check(spark, sf):
    """D-14 fit: of every series the training rows, the training end, and
    whether the fitted coefficients solve the normal equations of its Gram
    sums (the oracle expects every series, all solved)."""
    df = _forecast_input(fx.Monthly(spark, sf))
    keys = ["entity", "component"]
    ridge = 0.1
    model = fc.fit_forecast(df, keys, "ds", "y", DRIVERS, holdout=6, ridge=ridge, interval_calibration=0)
    both = _gram_of(df).join(model.select(*keys, "beta", "_ymu", "_ysd", "n_fit", "train_end"), keys, "left")
    p = len(fc.feature_names(3, DRIVERS))
    b = [(F.element_at("beta", i + 1) - (F.col("_ymu") if i == 0 else F.lit(0.0))) / F.col("_ysd") for i in range(p)]
    solved = F.lit(True)
    for i in range(p):
        left = sum((F.col(f"g_{min(i, j)}_{max(i, j)}") * b[j] for j in range(p)), F.lit(ridge if i >= 2 else 0.0) * b[i])
        solved = solved & (F.abs(left - F.col(f"xy_{i}")) <= F.lit(1e-7) * (F.lit(1.0) + F.abs(F.col(f"xy_{i}")) + F.col("n")))
    return both.select(*keys, F.col("n").alias("n_gram"), "n_fit", "train_end", F.coalesce(solved, F.lit(False)).alias("solved"))


@query("forecast_components")
def q_forecast_components(spark, sf):
    """D-14 full model: fit per (nation, component) with a 6-month holdout,
    predict from the first month to 24 months after the training end."""
    df = _forecast_input(fx.Monthly(spark, sf))
    keys = ["entity", "component"]
    # one row per series, read by the scoring frame and the prediction
    model = materialize(fc.fit_forecast(df, keys, "ds", "y", DRIVERS, holdout=6), "model")
    drv_nat = df.select("entity", "ds", *DRIVERS).dropDuplicates(["entity", "ds"])
    fut = fc.future_frame(df.select("entity", "component", "ds", "y"), model, drv_nat, keys, "ds", 24, DRIVERS,
                          driver_keys=["entity"])
    return fc.predict_forecast(fut, model, keys, "ds", DRIVERS)


@query("forecast_hinge_gram")
def q_forecast_hinge_gram(spark, sf):
    """D-14 piecewise trend: the sums of every candidate break's hinge column
    with all terms and the target, from prefix sums of the monthly buckets."""
    df = _forecast_input(fx.Monthly(spark, sf))
    keys = ["entity", "component"]
    w = Window.partitionBy(*keys).orderBy(F.col("ds").desc())
    train = df.filter(F.col("y").isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > 6).drop("_rn")
    stats, segments = pw.segment_gram(train, keys, "ds", "y", DRIVERS)
    return pw.hinge_sums(materialize(segments, "segments"), stats, keys, len(fc.feature_names(3, DRIVERS)))


@query("forecast_piecewise")
def q_forecast_piecewise(spark, sf):
    """D-14 with a trend that may bend and bounds by lead month, per (nation,
    component), to 24 months after the training end."""
    df = _forecast_input(fx.Monthly(spark, sf))
    keys = ["entity", "component"]
    model = materialize(pw.fit_piecewise(df, keys, "ds", "y", DRIVERS, holdout=6), "piecewise")
    drv_nat = df.select("entity", "ds", *DRIVERS).dropDuplicates(["entity", "ds"])
    fut = fc.future_frame(df.select("entity", "component", "ds", "y"), model, drv_nat, keys, "ds", 24, DRIVERS, driver_keys=["entity"])
    return pw.predict_piecewise(fut, model, keys, "ds", DRIVERS)


# ---------------------------------------------------------------- more inventory coverage
@query("training_frame")
def q_training_frame(spark, sf):
    """D-13 (second half): spliced revenue history joined with the global
    drivers; months lacking any driver are dropped."""
    m = fx.Monthly(spark, sf)
    return drv.training_frame(_spliced(m), m.drivers(), ["entity"], "ds")


@query("scenario_totals")
def q_scenario_totals(spark, sf):
    """D-19 totals: per-nation exact sums of both scenarios' net cash."""
    return ru.scenario_totals(q_scenario_comparison(spark, sf), ["entity"])


@query("dim_incremental")
def q_dim_incremental(spark, sf):
    """R-13 get-or-create: an existing brand dimension (parts of size < 25)
    keeps its ids; brands and types seen only now get ids after its max."""
    p = fx.table(spark, sf, "part")
    existing = dim.load_dimension([p.filter(F.col("p_size") < 25).select("p_brand")])
    return dim.load_dimension([p.select("p_brand"), p.select("p_type")], existing=existing)


# Statement line items kept by the income-statement catalog.
STATEMENT_CATALOG = ("revenue", "cogs_materials", "cogs_labor", "cogs_overhead", "operating_expenses",
                     "interest_expense", "taxes")


@query("statement_load")
def q_statement_load(spark, sf):
    """D-07: a sheet-like income statement per nation (two revisions of every
    month, spreadsheet-style column names, an extra non-catalog column) loaded
    into the catalog schema: names standardised, date column discovered,
    catalog columns kept, latest revision wins per (entity, month)."""
    inc = fx.income(spark, sf, by="nation")
    sheet_names = {"entity": "Entity", "ds": "Statement Date", "revenue": "Revenue",
                   "cogs_materials": "COGS - Materials", "cogs_labor": "COGS Labor",
                   "cogs_overhead": "COGS (Overhead)", "operating_expenses": "Operating Expenses",
                   "interest_expense": "Interest Expense", "taxes": "Taxes"}
    rev0 = inc.select(*[F.col(c).alias(n) for c, n in sheet_names.items()],
                      F.lit(0).alias("Revision"), F.lit("draft").alias("Notes"))
    rev1 = inc.select(*[(F.col(c) * F.lit(1.01) if c == "revenue" else F.col(c)).alias(n)
                        for c, n in sheet_names.items()],
                      F.lit(1).alias("Revision"), F.lit("final").alias("Notes"))
    src = rev0.unionByName(rev1).withColumn("Statement Date", F.col("Statement Date").cast("string"))
    return dim.load_statement(src, STATEMENT_CATALOG, key="statement_date", order_cols=["revision"],
                              keys=["entity"])


def _catalogue(spark, sf):
    """A stored statement table (all nations' months before 1997) loaded with
    a text sheet of all months: thousands marks, blanks, a tax figure that is
    no number (nation 3), months without a date (nation 5 in 1995), a column
    that the table lacks. Returns the table and the rejects."""
    inc = fx.income(spark, sf, by="nation")
    path = scratch_path(spark, "statements")
    inc.filter(F.col("ds") < F.lit("1997-01-01").cast("date")).select(
        "entity", F.col("ds").alias("statement_date"), F.floor("revenue").cast("double").alias("revenue"), "taxes",
        F.lit("opening").alias("status"), F.lit(None).cast("int").alias("revision")).write.parquet(path)
    lost = (F.col("entity") == 5) & (F.year("ds") == 1995)
    sheet = inc.select(
        F.col("entity").cast("string").alias("Entity"), F.when(~lost, F.col("ds").cast("string")).alias("Date"),
        F.concat(F.lit(" "), F.format_number(F.floor(F.col("revenue") * 1.5).cast("bigint"), 0)).alias("Revenue"),
        F.when(F.col("entity") == 3, F.lit("tba")).when(F.col("entity") != 4, F.floor("taxes").cast("string")).otherwise(F.lit(" ")).alias("Taxes"),
        F.lit("1").alias("Revision"), F.concat(F.lit("by "), F.col("entity").cast("string")).alias("Prepared-By"))
    rejects = statements.load_into_catalogue(materialize(sheet.toDF("Entity", "Date", "Revenue", "Taxes", "Revision", "Prepared_By"), "sheet"),
                                             path, keys=["entity"], order_cols=["revision"], add_columns=True)
    return spark.read.parquet(path), rejects


@query("csv_round_trip")
def q_csv_round_trip(spark, sf):
    """R-01..R-03, R-09, R-62, R-77, R-80: all orders written as CSV by status,
    sorted inside the files, and read back twice: with a typed schema, NaN
    prices to null, and as text cast later; codes reduced to letters and digits."""
    key = F.col("o_orderkey").cast("bigint")
    orders = fx.table(spark, sf, "orders").select(
        key.alias("k"), F.col("o_orderdate").cast("date").alias("ds"),
        F.when(key % 11 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.concat(F.lit("No. "), F.lower("o_orderpriority"), F.lit(" / "), "o_orderstatus").alias("code"), F.col("o_orderstatus").alias("status"))
    path = scratch_path(spark, "orders-csv")
    write_table(orders, path, "csv", partition_by=["status"], sort_within=["status", "k"])
    typed = clean_numeric(read_table(spark, path, "csv", "k bigint, ds date, price double, code string, status string"))
    text = read_csv_as_text(spark, path, ["k", "ds", "price", "code"], numeric=["price"])
    text = text.withColumns({"k": F.col("k").cast("bigint"), "ds": F.col("ds").cast("date"), "status": F.col("status").cast("string")})
    both = typed.withColumn("read_as", F.lit("typed")).unionByName(text.withColumn("read_as", F.lit("text")))
    return both.withColumn("code", alnum_only("code"))


@query("statement_catalogue")
def q_statement_catalogue(spark, sf):
    """R-14 / D-07: the stored table after the load; it keeps the status that
    the sheet lacks and gains the sheet's new column."""
    return _catalogue(spark, sf)[0]


@query("statement_catalogue_rejects")
def q_statement_catalogue_rejects(spark, sf):
    """The same load's rejects, counted by reason."""
    return _catalogue(spark, sf)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


# Profile attributes pivoted to columns.
PROFILE_ATTRS = ("Founded", "Employees", "Region", "Headquarters")


@query("profile_attributes")
def q_profile_attributes(spark, sf):
    """D-04: attribute/value rows per nation (founded year and head count as
    text, region name) pivoted to one row per company, ints parsed; rows
    without a company name are dropped."""
    n = fx.table(spark, sf, "nation")
    r = fx.table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    c = fx.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_cust"))
    base = n.join(r, "n_regionkey").join(c, "n_nationkey", "left")
    arr = F.array(
        F.struct(F.lit("Founded").alias("attribute"), (F.col("n_nationkey") + 1900).cast("string").alias("value")),
        F.struct(F.lit("Employees").alias("attribute"),
                 F.concat(F.coalesce(F.col("n_cust"), F.lit(0)).cast("string"), F.lit(".0")).alias("value")),
        F.struct(F.lit("Region").alias("attribute"), F.col("r_name").alias("value")))
    long = base.select(F.col("n_name").alias("company"), F.explode(arr).alias("_a")).select(
        "company", "_a.attribute", "_a.value")
    return dim.profile_pivot(long, "company", "attribute", "value", PROFILE_ATTRS,
                             int_attrs=["Founded", "Employees"])


@query("series_pivot")
def q_series_pivot(spark, sf):
    """R-06: a long macro-style table (series id, day, daily mean) pivoted to
    one column per listed series, renamed to model names."""
    long = cal.resample(fx.series_long(spark, sf).withColumnRenamed("series_id", "entity"), ["entity"], "ds",
                        ["value"], how="mean", freq="day").withColumnRenamed("entity", "series_id")
    return pivot_series(long, {t: f"{t}_value" for t in EVENT_TYPES})


# Statement line items (long form) and their column names.
STATEMENT_ITEMS = (("Total Revenue", "revenue"), ("Cost of Revenue", "cogs_materials"),
                   ("Operating Expense", "operating_expenses"), ("Tax Provision", "taxes"))


@query("statement_transpose")
def q_statement_transpose(spark, sf):
    """R-07: a supplier's statement stored long (ticker, item, date, value),
    as downloaded, transposed to one row per (ticker, fiscal year) with one
    column per listed item."""
    inc = fx.income(spark, sf, by="supplier", period="year")
    arr = F.array(*[F.struct(F.lit(item).alias("item"), F.col(col).alias("value")) for item, col in STATEMENT_ITEMS])
    long = inc.select(F.concat(F.lit("S"), F.col("entity").cast("string")).alias("ticker"),
                      F.make_date(F.col("fiscal_year"), F.lit(12), F.lit(31)).alias("date"),
                      F.explode(arr).alias("_i")).select("ticker", "_i.item", "date", "_i.value")
    return transpose_statement(long, [i for i, _ in STATEMENT_ITEMS])


@query("long_series_carries")
def q_long_series_carries(spark, sf):
    """R-54..R-57 on ONE series: all events by time, error readings missing:
    the value before and behind each row, both fills and the difference."""
    e = fx.table(spark, sf, "events").select("event_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    out = scans.carry(e, [], ["ts", "event_id"], forward={"filled": "value"}, backward={"next_known": "value"},
                      previous={"before": "value"}, following={"behind": "value"})
    return out.select("event_id", "value", "filled", "next_known", "before", "behind",
                      F.coalesce(F.col("value") - F.col("before"), F.lit(0.0)).alias("diff"))


@query("hot_entity_fill")
def q_hot_entity_fill(spark, sf):
    """R-57 at row grain where one entity holds most rows (all event types
    but two are one entity): forward, then backward, then 0."""
    e = fx.table(spark, sf, "events")
    who = F.when(F.col("event_type").isin("error", "view"), F.col("event_type")).otherwise(F.lit("rest"))
    part = e.select("event_id", "ts", who.alias("entity"), F.when(F.col("value") > 10, F.col("value")).alias("value"))
    return cal.fill_both(part, ["entity"], ["ts", "event_id"], ["value"], 0.0, hot=True).select("event_id", "entity", "value")


#: The orders as a text sheet.
ORDER_SHEET = sh.Sheet("orders", {"order": "int", "ordered": "date", "amount": "money", "discount": "percent", "note": "string"},
                       required=("order", "ordered"), options={"escape": '"'})


def _order_sheet(spark, sf):
    """All orders written as delimited text with what exports contain -
    thousands marks, quoted commas, blanks, bad dates and numbers, short
    lines - and read back into (rows, rejects)."""
    o = fx.table(spark, sf, "orders")
    k, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("bigint")
    amount = F.when(k % 11 == 0, F.lit("n/a")).when(k % 13 == 0, F.lit("")).otherwise(F.concat(
        F.lit('"'), F.expr("cast(cast(round(o_totalprice * 100) as bigint) div 100000 as string)"), F.lit(","),
        F.lpad(F.expr("(cast(round(o_totalprice * 100) as bigint) div 100) % 1000").cast("string"), 3, "0"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"), F.lit('"')))
    day = F.when(k % 17 == 0, F.lit("1996-13-45")).when(k % 19 == 0, F.lit(" ")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    share = F.when(k % 5 == 0, F.lit("N/A")).when(k % 7 == 0, F.lit("7 of 9")).otherwise(F.concat((k % 9).cast("string"), F.lit("%")))
    note = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', ""'), F.col("o_orderstatus"), F.lit('"""'))
    line = F.when(k % 23 == 0, F.concat_ws(",", k.cast("string"), day)).otherwise(
        F.concat_ws(",", F.concat(F.lit(" "), k.cast("string")), day, amount, share, note))
    path = scratch_path(spark, "sheets")
    o.select(line.alias("value")).write.text(f"{path}/orders")
    return sh.read_sheets(spark, path, [ORDER_SHEET, sh.Sheet("absent", {"a": "string"})])["orders"]


@query("text_sheet_rows")
def q_text_sheet_rows(spark, sf):
    """R-01..R-03, R-05, R-08: the typed rows of a text sheet."""
    return _order_sheet(spark, sf)[0].drop("source_file")


@query("text_sheet_rejects")
def q_text_sheet_rejects(spark, sf):
    """The same sheet's rejected lines, with the first reason."""
    return _order_sheet(spark, sf)[1].drop("source_file")


# Scenario window inside the forecast horizon of the fixtures (training ends mid-2001).
FORECAST_SHOCK_WINDOW = ("2001-06-01", "2002-12-31")


@query("scenario_forecast_comparison")
def q_scenario_forecast_comparison(spark, sf):
    """D-11 + D-14 + D-17 + D-19 chained as in the reference's scenario flow:
    fit the driver model per (nation, component) once, score the horizon with
    baseline drivers and with tariff-shocked drivers (shock applied to the
    filled future driver paths), roll each up to net cash flow and compare.
    Rows-only: it depends on the fitted model."""
    m = fx.Monthly(spark, sf)
    df = _forecast_input(m)
    keys = ["entity", "component"]
    # the model (one row per series) and the scoring frame feed several
    # branches: store each once instead of re-running the fit per branch
    model = materialize(fc.fit_forecast(df, keys, "ds", "y", DRIVERS, holdout=6), "model")
    drv_nat = df.select("entity", "ds", *DRIVERS).dropDuplicates(["entity", "ds"])
    fut = materialize(fc.future_frame(df.select("entity", "component", "ds", "y"), model, drv_nat, keys, "ds", 24,
                                      DRIVERS, driver_keys=["entity"]), "future")
    shocks = drv.shock_table(spark, "tariff", drv.TARIFF_SHOCKS, *FORECAST_SHOCK_WINDOW)
    fut_alt = drv.shock_drivers(fut, shocks, "ds", DRIVERS, keys=keys).drop("scenario").join(
        fut.select(*keys, "ds", "y"), keys + ["ds"], "inner")

    def wide(pred):
        # one row per (nation, month): <component>_actual / <component>_forecast
        return (pred.groupBy("entity", "ds").pivot("component", list(COMPONENTS))
                .agg(F.first("actual").alias("actual"), F.first("yhat").alias("forecast")))

    hist_ = _hist(_fact(m))
    capex = m.capex()
    cash = {}
    for name, frame in (("base", fut), ("tariff", fut_alt)):
        pred = fc.predict_forecast(frame, model, keys, "ds", DRIVERS)
        # entity x month table read by several roll-up branches
        comp = materialize(wide(pred), f"components_{name}")
        cash[name] = ru.net_cash_rollup(comp, hist_, capex, ["entity"], mode="forecast_start")
    return ru.compare_scenarios(cash["base"], cash["tariff"], keys=["entity"], window=FORECAST_SHOCK_WINDOW)
