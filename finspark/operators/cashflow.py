"""Monthly cash-flow fact (D-09) and the low-cost sanity patch (D-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dsum
from ..functions.names import ensure_columns
from ..sources.files import clean_numeric
from .calendar import diff_prev
from .joins import sized_broadcast

# Income statement columns of the fact, in output order.
INCOME_COLUMNS = ("revenue", "cogs_materials", "cogs_labor", "cogs_overhead",
                  "operating_expenses", "interest_expense", "taxes")
# Macro driver columns used across the forecasting operators.
DRIVER_COLUMNS = ("economic_activity_index", "consumer_confidence_index",
                  "interest_rate_proxy", "ev_component_cost_index")
DEBT_COLUMNS = ("long_term_debt", "short_term_debt", "net_debt_financing_activity")
CASH_FLOW_COLUMNS = ("inflow_operating_revenue", "outflow_cogs", "outflow_opex_raw", "outflow_opex",
                     "outflow_interest", "outflow_taxes", "net_operating_cash_flow",
                     "net_investing_cash_flow", "net_financing_cash_flow", "net_change_in_cash_total")


def low_cost_patch(cost, base, floor: float = 0.01, share: float = 0.15) -> Column:
    """D-10 expression: ``cost < floor * base`` (strict) -> ``share * base``."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    base = F.col(base) if isinstance(base, str) else base
    return F.when(cost < base * F.lit(floor), base * F.lit(share)).otherwise(cost)


def impute_low_cost(df: DataFrame, cost: str, base: str, floor: float = 0.01, share: float = 0.15,
                    raw_col: str | None = None, out: str | None = None,
                    flag_col: str | None = None) -> DataFrame:
    """D-10: keep the raw value in ``raw_col``, write the patched one to
    ``out`` (default: overwrite ``cost``), optionally flag patched rows."""
    out = out or cost
    cols = {}
    if raw_col:
        cols[raw_col] = F.col(cost)
    if flag_col:
        cols[flag_col] = F.col(cost) < F.col(base) * F.lit(floor)
    cols[out] = low_cost_patch(cost, base, floor, share)
    return df.withColumns(cols)


def net_debt_activity(debt: DataFrame, keys: Sequence[str], ds: str = "ds", also: Sequence[str] = ()) -> DataFrame:
    """Debt legs: nulls -> 0, total = long + short, net financing = change of
    total vs the previous debt row (first row 0). Taken on the debt table
    itself, before it is joined to the income months."""
    d = ensure_columns(debt, {"long_term_debt": "double", "short_term_debt": "double"})
    d = d.select(*keys, ds, *also,
                 F.coalesce(F.col("long_term_debt").cast("double"), F.lit(0.0)).alias("long_term_debt"),
                 F.coalesce(F.col("short_term_debt").cast("double"), F.lit(0.0)).alias("short_term_debt"))
    d = d.withColumn("_total_debt", F.col("long_term_debt") + F.col("short_term_debt"))
    d = diff_prev(d, keys, ds, "_total_debt", "net_debt_financing_activity")
    return d.drop("_total_debt")


def cash_flow_fact(income: DataFrame, capex: DataFrame | None = None,
                   indicators: DataFrame | None = None, debt: DataFrame | None = None,
                   keys: Sequence[str] = (), ds: str = "ds", opex_floor: float = 0.01,
                   opex_share: float = 0.15, driver_cols: Sequence[str] | None = None,
                   month_end: bool = False, legs: DataFrame | None = None) -> DataFrame:
    """D-09: one row per (keys, month) of ``income`` with capex, drivers,
    debt and the derived cash-flow legs.

    * capex: monthly sums, left-joined, missing -> 0;
    * indicators: monthly means, left-joined on the month (and ``keys``
      when the indicator table has them), forward-filled per entity;
    * debt: see :func:`net_debt_activity`; unmatched months -> 0;
    * income nulls -> 0; cogs = materials + labor + overhead; opex patched
      (D-10); CFO = revenue - (cogs + opex + interest + taxes); CFI = -capex;
      CFF = net financing; net = CFO + CFI + CFF.

    ``legs`` gives capex and debt together, one row per (keys, month) with
    ``capex_outflow`` and the debt columns: where both come from one source,
    it is read and joined once. It replaces ``capex`` and ``debt``.

    ``month_end=True`` declares that every input's ``ds`` is already a month
    end, so periods are not re-snapped (keeps the inputs' partitioning).

    Plan: income, capex and debt meet in equi-joins on (keys, ds), which
    their aggregations already hash-partition; the driver table (one row per
    month) is broadcast behind a size check; one exchange by ``keys`` then
    serves the forward-fill window.
    """
    keys = list(keys)
    # G1: a missing number may arrive as NaN; coalesce would keep it.
    if legs is not None and (capex is not None or debt is not None):
        raise ValueError("legs replaces capex and debt")
    income, capex, indicators, debt, legs = (None if t is None else clean_numeric(t)
                                             for t in (income, capex, indicators, debt, legs))

    def period(df):
        return F.col(ds) if month_end else F.last_day(F.col(ds).cast("date"))

    inc = ensure_columns(income, {c: "double" for c in INCOME_COLUMNS})
    fact = inc.select(*keys, period(inc).alias(ds),
                      *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in INCOME_COLUMNS])

    if legs is not None:
        lg = legs.withColumn(ds, period(legs))
        db = net_debt_activity(lg, keys, ds, also=["capex_outflow"])
        fact = fact.join(db, keys + [ds], "left")
        fact = fact.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("capex_outflow", *DEBT_COLUMNS)})
    elif capex is not None:
        cx = capex.groupBy(*keys, period(capex).alias(ds)).agg(
            dsum("capex_outflow").alias("capex_outflow"))
        fact = fact.join(cx, keys + [ds], "left")
        fact = fact.withColumn("capex_outflow", F.coalesce("capex_outflow", F.lit(0.0)))
    else:
        fact = fact.withColumn("capex_outflow", F.lit(0.0))

    if legs is not None:
        pass
    elif debt is not None:
        db = net_debt_activity(debt.withColumn(ds, period(debt)), keys, ds)
        fact = fact.join(db, keys + [ds], "left")
        fact = fact.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in DEBT_COLUMNS})
    else:
        fact = fact.withColumns({c: F.lit(0.0) for c in DEBT_COLUMNS})

    drivers = []
    if indicators is not None:
        drivers = list(driver_cols or [c for c in indicators.columns if c not in keys and c != ds])
        ind_keys = [k for k in keys if k in indicators.columns]
        # Monthly mean (indicator tables are usually one row per month already,
        # so this is the identity there and never re-rounds a value).
        ind = indicators.groupBy(*ind_keys, period(indicators).alias(ds)).agg(
            *[F.avg(F.col(c).cast("double")).alias(c) for c in drivers])
        # Driver tables are one row per month (times entity when keyed); the
        # hint is applied only when the planner's size estimate is small.
        fact = fact.join(sized_broadcast(ind) if not ind_keys else ind, ind_keys + [ds], "left")
        w = Window.partitionBy(*keys).orderBy(ds).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fact = fact.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in drivers})

    rev = F.col("revenue")
    fact = fact.withColumns({
        "inflow_operating_revenue": rev,
        "outflow_cogs": F.col("cogs_materials") + F.col("cogs_labor") + F.col("cogs_overhead"),
        "outflow_opex_raw": F.col("operating_expenses"),
        "outflow_opex": low_cost_patch("operating_expenses", rev, opex_floor, opex_share),
        "outflow_interest": F.col("interest_expense"),
        "outflow_taxes": F.col("taxes"),
    })
    fact = fact.withColumn(
        "net_operating_cash_flow",
        F.col("inflow_operating_revenue") - (F.col("outflow_cogs") + F.col("outflow_opex")
                                             + F.col("outflow_interest") + F.col("outflow_taxes")))
    fact = fact.withColumns({"net_investing_cash_flow": -F.col("capex_outflow"),
                             "net_financing_cash_flow": F.col("net_debt_financing_activity")})
    fact = fact.withColumn("net_change_in_cash_total",
                           F.col("net_operating_cash_flow") + F.col("net_investing_cash_flow")
                           + F.col("net_financing_cash_flow"))
    return fact.select(*keys, ds, *INCOME_COLUMNS, "capex_outflow", *drivers, *DEBT_COLUMNS,
                       *CASH_FLOW_COLUMNS)
