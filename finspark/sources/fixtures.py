"""Adapters from the driver's star-schema tables to financial shapes.

Each adapter reads only the columns it needs (pruned at the parquet scan)
and aggregates raw rows *before* joining them to a dimension: a supplier or
customer holding a third of all rows collapses to one row per month before
any exchange, so joins never see raw-row skew. Money sums are exact and
order-independent: per-row values become scaled ``bigint`` units of 10^-4
(:func:`~finspark.functions.expr.scaled`), summed as longs at both levels,
and turned back into doubles once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import scaled, unscaled
from ..session import materialize

# Table names provided by the driver.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dsum(c: Column) -> Column:
    """Exact partial sum (scaled long)."""
    return F.sum(scaled(c))


def _dsum_if(pred: Column, c: Column) -> Column:
    return F.sum(F.when(pred, scaled(c)).otherwise(F.lit(0).cast("bigint")))


def _income_partials(li: DataFrame, key: str, period: Column) -> DataFrame:
    ext, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    rf = F.col("l_returnflag")
    return li.groupBy(F.col(key).alias("_k"), period.alias("ds")).agg(
        _dsum(ext * (F.lit(1.0) - disc)).alias("revenue"),
        _dsum_if(rf == "R", ext).alias("cogs_materials"),
        _dsum_if(rf == "A", ext).alias("cogs_labor"),
        _dsum_if(rf == "N", ext * tax).alias("cogs_overhead"),
        _dsum(ext * disc).alias("operating_expenses"),
        _dsum(F.col("l_quantity")).alias("interest_expense"),
        _dsum(ext * tax).alias("taxes"),
    )


INCOME_OUT = ("revenue", "cogs_materials", "cogs_labor", "cogs_overhead",
              "operating_expenses", "interest_expense", "taxes")


def income(spark: SparkSession, sf_dir: str, by: str = "nation", period: str = "month") -> DataFrame:
    """``income(entity, ds, revenue, cogs_*, operating_expenses, interest_expense, taxes)``.

    ``by='supplier'``: entity = l_suppkey; ``by='nation'``: entity =
    supplier nation. ``period`` is 'month' (ds = month end) or 'year'
    (``fiscal_year``)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_returnflag")
    pcol = (F.last_day(F.col("l_shipdate").cast("date")) if period == "month"
            else F.year("l_shipdate"))
    part = _income_partials(li, "l_suppkey", pcol)
    if by == "supplier":
        sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("_k"))
        out = part.join(sup, "_k", "left_semi").withColumnRenamed("_k", "entity")
        out = out.select(F.col("entity").cast("bigint"), "ds", *[unscaled(c).alias(c) for c in INCOME_OUT])
    elif by == "nation":
        sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("_k"), "s_nationkey")
        out = (part.join(sup, "_k").groupBy(F.col("s_nationkey").cast("bigint").alias("entity"), "ds")
               .agg(*[unscaled(F.sum(c)).alias(c) for c in INCOME_OUT]))
    else:
        raise ValueError(by)
    if period == "year":
        out = out.withColumnRenamed("ds", "fiscal_year")
    return out


def orders_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (customer nation, month): urgent order value (capex), finished /
    pending order value (long / short debt)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice",
                                               "o_orderstatus", "o_orderpriority")
    p = F.col("o_totalprice")
    part = o.groupBy("o_custkey", F.last_day(F.col("o_orderdate").cast("date")).alias("ds")).agg(
        _dsum_if(F.col("o_orderpriority") == "1-URGENT", p).alias("capex"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("n_urgent"),
        _dsum_if(F.col("o_orderstatus") == "F", p).alias("long_term_debt"),
        _dsum_if(F.col("o_orderstatus") == "P", p).alias("short_term_debt"),
    )
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (part.join(cust, "o_custkey")
            .groupBy(F.col("c_nationkey").cast("bigint").alias("entity"), "ds")
            .agg(unscaled(F.sum("capex")).alias("capex"), F.sum("n_urgent").alias("n_urgent"),
                 unscaled(F.sum("long_term_debt")).alias("long_term_debt"),
                 unscaled(F.sum("short_term_debt")).alias("short_term_debt")))


def capex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``capex(entity, ds, capex_outflow)``: months with urgent orders only."""
    m = orders_monthly(spark, sf_dir)
    return m.filter(F.col("n_urgent") > 0).select("entity", "ds", F.col("capex").alias("capex_outflow"))


def debt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``debt(entity, ds, long_term_debt, short_term_debt)``: every month with orders."""
    return orders_monthly(spark, sf_dir).select("entity", "ds", "long_term_debt", "short_term_debt")


def capex_and_debt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both of the above from one pass over the orders: one row per month
    with orders, no capex where none is urgent."""
    return orders_monthly(spark, sf_dir).select(
        "entity", "ds", F.when(F.col("n_urgent") > 0, F.col("capex")).alias("capex_outflow"), "long_term_debt", "short_term_debt")


def _mean(c: Column) -> Column:
    return F.try_divide(unscaled(F.sum(scaled(c))), F.count(c).cast("double"))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``drivers(ds, 4 indicators)``: global monthly macro-like series.
    Order-side and ship-side months are full-outer joined, so months with
    only one side carry nulls (filled downstream)."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    od = o.groupBy(F.last_day(F.col("o_orderdate").cast("date")).alias("ds")).agg(
        F.count(F.lit(1)).cast("double").alias("economic_activity_index"),
        _mean(F.col("o_totalprice")).alias("consumer_confidence_index"))
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_discount", "l_extendedprice", "l_quantity")
    ld = li.groupBy(F.last_day(F.col("l_shipdate").cast("date")).alias("ds")).agg(
        _mean(F.col("l_discount")).alias("interest_rate_proxy"),
        F.try_divide(unscaled(F.sum(scaled(F.col("l_extendedprice")))),
                     unscaled(F.sum(scaled(F.col("l_quantity"))))).alias("ev_component_cost_index"))
    return od.join(ld, "ds", "full_outer")


def user_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``series_long`` by user: (entity = user_id, ds = day, value)."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    return e.select(F.col("user_id").cast("bigint").alias("entity"),
                    F.col("ts").cast("date").alias("ds"), F.col("value").cast("double"))


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``series_long``: (series_id = event_type, ds = day, value)."""
    e = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    return e.select(F.col("event_type").alias("series_id"), F.col("ts").cast("date").alias("ds"),
                    F.col("value").cast("double"))


def balance_year_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-end balance per (customer nation, year): the latest order of the
    year (tie-break on the higher order key) supplies the figures. Uses
    ``max_by`` (partial aggregation, no sort; a hot nation stays cheap)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    order_key = F.struct("o_orderdate", "o_orderkey")
    # Latest order per (customer, year) first: at most one row per customer
    # and year reaches the join, then the latest of those per nation.
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("fiscal_year")).agg(
        F.max_by(F.struct("o_totalprice", order_key.alias("k")), order_key).alias("r"))
    last = (per_cust.join(c, "o_custkey")
            .groupBy(F.col("c_nationkey").cast("bigint").alias("nation"), "fiscal_year")
            .agg(F.max_by(F.struct(F.col("r.o_totalprice").alias("o_totalprice"), "c_acctbal"),
                          F.col("r.k")).alias("r")))
    p, a = F.col("r.o_totalprice"), F.col("r.c_acctbal")
    return last.select(
        "nation", "fiscal_year",
        (p * F.lit(10.0)).alias("total_assets"),
        (p * F.lit(6.0)).alias("total_current_assets"),
        (p * F.lit(0.5)).alias("inventory_raw_materials"),
        (p * F.lit(0.25)).alias("inventory_wip"),
        (p * F.lit(0.75)).alias("inventory_finished_goods"),
        (p * F.lit(1.5)).alias("accounts_payable"),
        (p * F.lit(2.0)).alias("long_term_debt"),
        (p * F.lit(0.5)).alias("short_term_debt"),
        (p * F.lit(3.0)).alias("total_current_liabilities"),
        (p * F.lit(4.0) - a).alias("total_liabilities"),
        (p * F.lit(6.0) + a).alias("total_equity"),
        a.alias("cash"),
    )


def dup_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dup_facts``: lineitem keyed (l_orderkey, l_linenumber), not unique."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def depts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``depts``: one department per (market segment, nation) with requested
    budget and optional bounds (exact decimals) and three double scores.
    Departments of region 1 have no minimum, of region 3 no maximum."""
    c = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    g = c.groupBy("c_mktsegment", "c_nationkey").agg(
        F.sum(scaled(F.abs("c_acctbal"))).alias("_req"),
        F.sum(scaled(F.col("c_acctbal"))).alias("_bal"),
        F.count(F.lit(1)).alias("_n")).join(n, "c_nationkey")
    # back to an exact decimal amount for the allocation arithmetic
    g = g.withColumn("requested", F.col("_req").cast("decimal(28,0)") * F.lit(0.0001).cast("decimal(4,4)"))
    req = F.col("requested")
    nk = F.col("c_nationkey")
    reg = F.col("n_regionkey")
    return g.select(
        F.concat_ws("-", "c_mktsegment", nk.cast("string")).alias("department"),
        req.alias("requested_budget"),
        F.when(reg == 1, F.lit(None)).otherwise(req * F.lit(0.7).cast("decimal(2,1)")).alias("min_required"),
        F.when(reg == 3, F.lit(None)).otherwise(req * F.lit(1.2).cast("decimal(2,1)")).alias("max_plausible"),
        (unscaled(F.col("_bal")) / F.col("_n").cast("double") / F.lit(1000.0)).alias("roi_score"),
        (F.col("_n").cast("double") / F.lit(10.0)).alias("efficiency_score"),
        (F.lit(25.0) - nk.cast("double")).alias("strategic_score"),
    )


def balance_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-end balance per customer nation: the month's latest order
    supplies the figures (same formulas as :func:`balance_year_end`)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    order_key = F.struct("o_orderdate", "o_orderkey")
    month = F.last_day(F.col("o_orderdate").cast("date"))
    per_cust = o.groupBy("o_custkey", month.alias("balance_date")).agg(
        F.max_by(F.struct("o_totalprice", order_key.alias("k")), order_key).alias("r"))
    last = (per_cust.join(c, "o_custkey")
            .groupBy(F.col("c_nationkey").cast("bigint").alias("nation"), "balance_date")
            .agg(F.max_by(F.struct(F.col("r.o_totalprice").alias("o_totalprice"), "c_acctbal"),
                          F.col("r.k")).alias("r")))
    p, a = F.col("r.o_totalprice"), F.col("r.c_acctbal")
    return last.select("nation", "balance_date", *_balance_figures(p, a))


def _balance_figures(p: Column, a: Column) -> list[Column]:
    return [
        (p * F.lit(10.0)).alias("total_assets"),
        (p * F.lit(6.0)).alias("total_current_assets"),
        (p * F.lit(0.5)).alias("inventory_raw_materials"),
        (p * F.lit(0.25)).alias("inventory_wip"),
        (p * F.lit(0.75)).alias("inventory_finished_goods"),
        (p * F.lit(1.5)).alias("accounts_payable"),
        (p * F.lit(2.0)).alias("long_term_debt"),
        (p * F.lit(0.5)).alias("short_term_debt"),
        (p * F.lit(3.0)).alias("total_current_liabilities"),
        (p * F.lit(4.0) - a).alias("total_liabilities"),
        (p * F.lit(6.0) + a).alias("total_equity"),
        a.alias("cash"),
    ]


def supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("entity"),
                                                    F.col("s_nationkey").cast("bigint").alias("nation"))


def drivers_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro-like drivers per (nation, month): order count and mean order
    value by customer nation; mean discount and unit price by supplier
    nation. Raw rows are pre-aggregated per customer / supplier and month
    before the dimension join."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    op = o.groupBy("o_custkey", F.last_day(F.col("o_orderdate").cast("date")).alias("ds")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(scaled(F.col("o_totalprice"))).alias("p"),
        F.count("o_totalprice").alias("np"))
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    od = (op.join(cust, "o_custkey").groupBy(F.col("c_nationkey").cast("bigint").alias("entity"), "ds")
          .agg(F.sum("n").cast("double").alias("economic_activity_index"),
               F.try_divide(unscaled(F.sum("p")), F.sum("np").cast("double")).alias("consumer_confidence_index")))
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_discount", "l_extendedprice", "l_quantity")
    lp = li.groupBy("l_suppkey", F.last_day(F.col("l_shipdate").cast("date")).alias("ds")).agg(
        F.sum(scaled(F.col("l_discount"))).alias("d"), F.count("l_discount").alias("nd"),
        F.sum(scaled(F.col("l_extendedprice"))).alias("e"), F.sum(scaled(F.col("l_quantity"))).alias("q"))
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    ld = (lp.join(sup, "l_suppkey").groupBy(F.col("s_nationkey").cast("bigint").alias("entity"), "ds")
          .agg(F.try_divide(unscaled(F.sum("d")), F.sum("nd").cast("double")).alias("interest_rate_proxy"),
               F.try_divide(unscaled(F.sum("e")), unscaled(F.sum("q"))).alias("ev_component_cost_index")))
    return od.join(ld, ["entity", "ds"], "full_outer")


def order_revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order value per customer nation (an older, coarser revenue proxy)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    op = o.groupBy("o_custkey", F.last_day(F.col("o_orderdate").cast("date")).alias("ds")).agg(
        F.sum(scaled(F.col("o_totalprice"))).alias("p"))
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (op.join(cust, "o_custkey").groupBy(F.col("c_nationkey").cast("bigint").alias("entity"), "ds")
            .agg(unscaled(F.sum("p")).alias("revenue")))


class Monthly:
    """The adapters at (nation, month) grain from ONE scan of each fact
    table. What several of them need is summed together, as exact long units,
    to one small row per nation and month, and stored; income, capex, debt
    and drivers are columns of that. Same values as the functions above."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._lines: DataFrame | None = None
        self._orders: DataFrame | None = None

    def lines(self) -> DataFrame:
        """entity, ds, ``known`` (the supplier is in its table), sums of the lineitems."""
        if self._lines is None:
            li = table(self.spark, self.sf_dir, "lineitem").select(
                "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_returnflag")
            ext, disc, tax, flag = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag"))
            part = li.groupBy(F.col("l_suppkey").alias("_k"), F.last_day(F.col("l_shipdate").cast("date")).alias("ds")).agg(
                _dsum(ext * (F.lit(1.0) - disc)).alias("revenue"), _dsum_if(flag == "R", ext).alias("cogs_materials"),
                _dsum_if(flag == "A", ext).alias("cogs_labor"), _dsum_if(flag == "N", ext * tax).alias("cogs_overhead"),
                _dsum(ext * disc).alias("operating_expenses"), _dsum(F.col("l_quantity")).alias("interest_expense"),
                _dsum(ext * tax).alias("taxes"), _dsum(disc).alias("discount"), F.count(disc).alias("n_discount"), _dsum(ext).alias("price"))
            sup = table(self.spark, self.sf_dir, "supplier").select(F.col("s_suppkey").alias("_k"), "s_nationkey", F.lit(True).alias("known"))
            sums = [c for c in part.columns if c not in ("_k", "ds")]
            self._lines = materialize(part.join(sup, "_k", "left").groupBy(
                F.col("s_nationkey").cast("bigint").alias("entity"), F.coalesce("known", F.lit(False)).alias("known"), "ds").agg(
                *[F.sum(c).alias(c) for c in sums]), "lines")
        return self._lines

    def orders(self) -> DataFrame:
        """entity, ds, ``known`` (the customer is in its table), sums of the orders."""
        if self._orders is None:
            o = table(self.spark, self.sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority")
            p, urgent = F.col("o_totalprice"), F.col("o_orderpriority") == "1-URGENT"
            part = o.groupBy(F.col("o_custkey").alias("_k"), F.last_day(F.col("o_orderdate").cast("date")).alias("ds")).agg(
                _dsum_if(urgent, p).alias("capex"), F.sum(F.when(urgent, 1).otherwise(0)).alias("n_urgent"),
                _dsum_if(F.col("o_orderstatus") == "F", p).alias("long_term_debt"),
                _dsum_if(F.col("o_orderstatus") == "P", p).alias("short_term_debt"),
                F.count(F.lit(1)).alias("n"), _dsum(p).alias("price"), F.count(p).alias("n_price"))
            cust = table(self.spark, self.sf_dir, "customer").select(F.col("c_custkey").alias("_k"), "c_nationkey", F.lit(True).alias("known"))
            sums = [c for c in part.columns if c not in ("_k", "ds")]
            self._orders = materialize(part.join(cust, "_k", "left").groupBy(
                F.col("c_nationkey").cast("bigint").alias("entity"), F.coalesce("known", F.lit(False)).alias("known"), "ds").agg(
                *[F.sum(c).alias(c) for c in sums]), "orders")
        return self._orders

    def income(self) -> DataFrame:
        return self.lines().filter("known").select("entity", "ds", *[unscaled(c).alias(c) for c in INCOME_OUT])

    def capex(self) -> DataFrame:
        return self.orders().filter("known and n_urgent > 0").select("entity", "ds", unscaled("capex").alias("capex_outflow"))

    def debt(self) -> DataFrame:
        return self.orders().filter("known").select("entity", "ds", unscaled("long_term_debt").alias("long_term_debt"),
                                                    unscaled("short_term_debt").alias("short_term_debt"))

    def capex_and_debt(self) -> DataFrame:
        return self.orders().filter("known").select(
            "entity", "ds", F.when(F.col("n_urgent") > 0, unscaled("capex")).alias("capex_outflow"),
            unscaled("long_term_debt").alias("long_term_debt"), unscaled("short_term_debt").alias("short_term_debt"))

    def order_revenue(self) -> DataFrame:
        return self.orders().filter("known").select("entity", "ds", unscaled("price").alias("revenue"))

    def _drivers(self, keys: list[str]) -> DataFrame:
        lines, orders = (d.filter("known") if len(keys) > 1 else d for d in (self.lines(), self.orders()))
        od = orders.groupBy(*keys).agg(
            F.sum("n").cast("double").alias("economic_activity_index"),
            F.try_divide(unscaled(F.sum("price")), F.sum("n_price").cast("double")).alias("consumer_confidence_index"))
        ld = lines.groupBy(*keys).agg(
            F.try_divide(unscaled(F.sum("discount")), F.sum("n_discount").cast("double")).alias("interest_rate_proxy"),
            F.try_divide(unscaled(F.sum("price")), unscaled(F.sum("interest_expense"))).alias("ev_component_cost_index"))
        return od.join(ld, keys, "full_outer")

    def drivers(self) -> DataFrame:
        return self._drivers(["ds"])

    def drivers_by_nation(self) -> DataFrame:
        return self._drivers(["entity", "ds"])
