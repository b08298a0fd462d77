"""Annual statements, equity derivation and the 14 benchmark ratios (D-20 .. D-22).

One pass for all companies: yearly sums by ``(keys, year)``, the year-end
balance row by ``max_by`` (no sort), one ``lag`` window for growth and one
``explode`` to the long ratio table. No per-company loop, no N+1 queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_div, scaled, unscaled

# Ratio categories and names (as stored in the ratio table).
LEVEL_RATIOS = (
    ("Profitability", "Gross Profit Margin"),
    ("Profitability", "Operating Profit Margin"),
    ("Profitability", "Net Profit Margin"),
    ("Profitability", "Return on Assets (ROA)"),
    ("Profitability", "Return on Equity (ROE)"),
    ("Liquidity", "Current Ratio"),
    ("Liquidity", "Quick Ratio (Acid Test)"),
    ("Solvency", "Debt-to-Equity Ratio"),
    ("Solvency", "Debt-to-Assets Ratio"),
    ("Solvency", "Interest Coverage Ratio"),
    ("Efficiency", "Asset Turnover"),
    ("Efficiency", "Inventory Turnover"),
)
GROWTH_RATIOS = (
    ("Growth", "Revenue Growth YoY"),
    ("Growth", "Net Income Growth YoY"),
)

BALANCE_COLUMNS = ("total_assets", "inventory", "accounts_payable", "long_term_debt",
                   "total_current_assets", "total_current_liabilities", "total_liabilities",
                   "total_equity", "cash_and_equivalents")


def _d(c: str) -> Column:
    return scaled(c)


def annual_income(income: DataFrame, keys: Sequence[str], ds: str = "ds",
                  year: str = "fiscal_year") -> DataFrame:
    """R-40: yearly sums of a monthly income table, including sums of
    expressions (cogs, gross profit, EBIT, net income). Exact fixed-point
    arithmetic; a null addend nulls its row's expression, which ``sum`` skips."""
    cogs = _d("cogs_materials") + _d("cogs_labor") + _d("cogs_overhead")
    gross = _d("revenue") - cogs
    ebit = gross - _d("operating_expenses")
    net = ebit - _d("interest_expense") - _d("taxes")
    return income.groupBy(*keys, F.year(ds).alias(year)).agg(
        unscaled(F.sum(_d("revenue"))).alias("total_revenue"),
        unscaled(F.sum(cogs)).alias("cost_of_revenue"),
        unscaled(F.sum(gross)).alias("gross_profit"),
        unscaled(F.sum(ebit)).alias("operating_income"),
        unscaled(F.sum(_d("interest_expense"))).alias("interest_expense"),
        unscaled(F.sum(net)).alias("net_income"),
    )


def year_end_balance(balance: DataFrame, keys: Sequence[str], ds: str = "balance_date",
                     year: str = "fiscal_year") -> DataFrame:
    """R-43: the latest balance row of each (keys, year) (``DISTINCT ON ..
    ORDER BY date DESC``) as ``max_by``; inventory = raw + wip + finished."""
    vals = [c for c in balance.columns if c not in keys and c != ds]
    last = balance.groupBy(*keys, F.year(ds).alias(year)).agg(
        F.max_by(F.struct(*vals), F.col(ds)).alias("_r"))
    out = last.select(*keys, year, *[F.col(f"_r.{c}").alias(c) for c in vals])
    if {"inventory_raw_materials", "inventory_wip", "inventory_finished_goods"} <= set(vals):
        out = out.withColumn("inventory", F.col("inventory_raw_materials") + F.col("inventory_wip")
                             + F.col("inventory_finished_goods"))
    if "cash" in vals and "cash_and_equivalents" not in vals:
        out = out.withColumnRenamed("cash", "cash_and_equivalents")
    return out


def annualise(income: DataFrame, balance: DataFrame, keys: Sequence[str], ds: str = "ds",
              balance_ds: str = "balance_date", year: str = "fiscal_year") -> DataFrame:
    """D-20: yearly income sums inner-joined with the year-end balance."""
    keys = list(keys)
    inc = annual_income(income, keys, ds, year)
    bal = year_end_balance(balance, keys, balance_ds, year)
    keep = [c for c in BALANCE_COLUMNS if c in bal.columns]
    return inc.join(bal.select(*keys, year, *keep), keys + [year], "inner")


def derive_equity(df: DataFrame, keys: Sequence[str], equity: str = "total_equity",
                  assets: str = "total_assets", liabilities: str = "total_liabilities") -> DataFrame:
    """D-22: a company with no equity value in any year, but some assets and
    some liabilities, gets equity = assets - liabilities (all its years).
    Counting runs as a grouped aggregate joined back (map-side combined), not
    a window, so a company with many rows is not sorted in one task."""
    keys = list(keys)
    if equity not in df.columns:
        df = df.withColumn(equity, F.lit(None).cast("double"))
    flags = df.groupBy(*keys).agg(
        ((F.count(equity) == 0) & (F.count(assets) > 0) & (F.count(liabilities) > 0)).alias("_derive"))
    out = df.join(flags, keys, "left")
    return out.withColumn(equity, F.when(F.col("_derive"), F.col(assets) - F.col(liabilities))
                          .otherwise(F.col(equity))).drop("_derive")


def _level_exprs() -> list[Column]:
    c = F.col
    quick_assets = c("total_current_assets") - c("inventory")  # null if either is null
    vals = [
        safe_div("gross_profit", "total_revenue"),
        safe_div("operating_income", "total_revenue"),
        safe_div("net_income", "total_revenue"),
        safe_div("net_income", "total_assets"),
        safe_div("net_income", "total_equity"),
        safe_div("total_current_assets", "total_current_liabilities"),
        safe_div(quick_assets, "total_current_liabilities"),
        safe_div("total_liabilities", "total_equity"),
        safe_div("total_liabilities", "total_assets"),
        safe_div("operating_income", "interest_expense"),
        safe_div("total_revenue", "total_assets"),
        safe_div("cost_of_revenue", "inventory"),
    ]
    return [F.struct(F.lit(cat).alias("ratio_category"), F.lit(name).alias("ratio_name"),
                     v.alias("ratio_value"))
            for (cat, name), v in zip(LEVEL_RATIOS, vals)]


def _growth(cur: str, keys: Sequence[str], year: str) -> Column:
    """(cur - prev) / |prev| against the previous *row* (G6), null when the
    previous value is null or 0 or there is no previous row."""
    prev = F.lag(cur).over(Window.partitionBy(*keys).orderBy(year))
    return safe_div(F.col(cur) - prev, F.abs(prev))


def financial_ratios(annual: DataFrame, keys: Sequence[str], year: str = "fiscal_year",
                     include: str = "all") -> DataFrame:
    """D-21: long ratio table ``(keys, year, ratio_category, ratio_name,
    ratio_value)`` with null values dropped. ``include``: 'level',
    'growth' or 'all'."""
    keys = list(keys)
    df = annual
    for c in ("total_revenue", "gross_profit", "operating_income", "net_income", "total_assets",
              "total_equity", "total_current_assets", "total_current_liabilities", "inventory",
              "total_liabilities", "interest_expense", "cost_of_revenue"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    structs: list[Column] = []
    if include in ("level", "all"):
        structs += _level_exprs()
    if include in ("growth", "all"):
        # One window (same partition/order for both columns), then the explode.
        df = df.withColumns({f"_g_{src}": _growth(src, keys, year)
                             for src in ("total_revenue", "net_income")})
        for (cat, name), src in zip(GROWTH_RATIOS, ("total_revenue", "net_income")):
            structs.append(F.struct(F.lit(cat).alias("ratio_category"), F.lit(name).alias("ratio_name"),
                                    F.col(f"_g_{src}").alias("ratio_value")))
    long = df.select(*keys, year, F.explode(F.array(*structs)).alias("_r"))
    return (long.select(*keys, year, "_r.ratio_category", "_r.ratio_name", "_r.ratio_value")
            .filter(F.col("ratio_value").isNotNull()))
