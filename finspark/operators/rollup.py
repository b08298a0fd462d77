"""Roll component forecasts up to net cash flow, elasticity overlay and
scenario comparison (D-17 .. D-19).

Inputs are long-lived monthly tables keyed by ``(keys, ds)``; every step is a
column expression, a keyed join or a grouped aggregate joined back (the
per-entity "last debt before the forecast" is ``max_by``, not a sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_sum
from .joins import attach_scalars

# Interest on projected long-term debt (annual rate, months per year)
# and the tax rate on positive earnings before tax.
INTEREST_RATE = 0.03
MONTHS_PER_YEAR = 12
TAX_RATE = 0.25
# Revenue elasticities to activity and confidence changes.
ELASTICITY_ACTIVITY = 0.6
ELASTICITY_CONFIDENCE = 0.4
ELASTICITY_COST = 0.6

TARGETS = ("inflow_operating_revenue", "outflow_cogs", "outflow_opex")
OUT = ("inflow_operating_revenue_final", "outflow_cogs_final", "outflow_opex_final", "outflow_interest_final",
       "outflow_taxes_final", "net_operating_cash_flow", "net_investing_cash_flow", "net_financing_cash_flow",
       "net_change_in_cash_total")


def merge_actuals_and_forecasts(components: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """R-22: ``<t>_final = coalesce(<t>_actual, <t>_forecast)`` (kept when
    already present, e.g. after an elasticity overlay)."""
    return components.withColumns({f"{t}_final": F.coalesce(f"{t}_actual", f"{t}_forecast") for t in targets
                                   if f"{t}_final" not in components.columns})


def _hist_col(df: DataFrame, c: str) -> Column:
    return F.col(c) if c in df.columns else F.lit(None).cast("double")


def net_cash_rollup(components: DataFrame, hist: DataFrame, capex: DataFrame | None = None,
                    keys: Sequence[str] = (), ds: str = "ds", mode: str = "forecast_start",
                    null_as_zero: bool | None = None) -> DataFrame:
    """D-17: final = actual else forecast for revenue, cogs and opex; interest
    = actual else projected long-term debt x 3% / 12; EBIT; EBT; tax = actual
    else 25% x max(EBT, 0); cash-flow legs and total.

    ``mode='forecast_start'``: debt is projected from the first month whose
    revenue actual is missing, using the last debt value before it; capex
    comes from ``capex`` (missing = 0); missing legs count as 0 in the total.
    ``mode='everywhere'``: the last debt value of the history is projected on
    every month; capex comes from ``hist`` (so forecast months have none);
    a missing leg makes the total missing (G7, G8)."""
    keys = list(keys)
    if null_as_zero is None:
        null_as_zero = mode == "forecast_start"
    comp = merge_actuals_and_forecasts(components)
    hcols = {"interest_expense": "_h_interest", "taxes": "_h_taxes", "long_term_debt": "_h_ltd",
             "net_debt_financing_activity": "_h_netfin", "capex_outflow": "_h_capex"}
    h = hist.select(*keys, ds, *[_hist_col(hist, c).alias(a) for c, a in hcols.items()])
    df = comp.join(h, keys + [ds], "left")

    def attach(frame, stats):
        return frame.join(stats, keys, "left") if keys else attach_scalars(frame, stats)

    if mode == "forecast_start":
        # Per-entity statistics from the components and history only (small
        # grouped aggregates joined back); capex is joined once afterwards.
        start = comp.groupBy(*keys).agg(
            F.min(F.when(F.col("inflow_operating_revenue_actual").isNull(), F.col(ds))).alias("_start"))
        before = (F.col(ds) < F.col("_start")) & F.col("_h_ltd").isNotNull()
        last = attach(df, start).groupBy(*keys).agg(
            F.first("_start").alias("_start"), F.max_by(F.col("_h_ltd"), F.when(before, F.col(ds))).alias("_last_ltd"))
        df = attach(df, last)
        if capex is not None:
            cx = capex.groupBy(*keys, ds).agg(F.sum("capex_outflow").alias("_capex"))
            df = df.join(cx, keys + [ds], "left")
        else:
            df = df.withColumn("_capex", F.lit(None))
        df = df.withColumn("_capex", F.coalesce(F.col("_capex").cast("double"), F.lit(0.0)))
        ltd = F.when(F.col(ds) >= F.col("_start"), F.coalesce(F.col("_last_ltd"), F.lit(0.0)))
        netfin = F.coalesce(F.col("_h_netfin"), F.lit(0.0))
    elif mode == "everywhere":
        last = hist.groupBy(*keys).agg(F.max_by(F.col("long_term_debt"),
                                                F.when(F.col("long_term_debt").isNotNull(), F.col(ds))).alias("_last_ltd"))
        df = attach(df, last)
        ltd = F.col("_last_ltd")
        df = df.withColumn("_capex", F.col("_h_capex"))
        netfin = F.col("_h_netfin")
    else:
        raise ValueError(mode)

    rev, cogs, opex = (F.col(f"{t}_final") for t in TARGETS)
    interest_calc = F.coalesce(ltd, F.lit(0.0)) * F.lit(INTEREST_RATE) / F.lit(float(MONTHS_PER_YEAR))
    df = df.withColumn("outflow_interest_final", F.coalesce(F.col("_h_interest"), interest_calc))
    if mode == "forecast_start":
        ebit_a = rev - (cogs + opex)
        ebit_f = F.col("inflow_operating_revenue_forecast") - (F.col("outflow_cogs_forecast")
                                                                + F.col("outflow_opex_forecast"))
        ebt = (F.coalesce(F.coalesce(ebit_a, ebit_f), F.lit(0.0))
               - F.coalesce(F.col("outflow_interest_final"), F.lit(0.0)))
    else:
        ebt = (rev - (cogs + opex)) - F.col("outflow_interest_final")
    tax_calc = F.when(ebt > 0, ebt * F.lit(TAX_RATE)).otherwise(F.lit(0.0))
    df = df.withColumn("outflow_taxes_final", F.coalesce(F.col("_h_taxes"), tax_calc))
    df = df.withColumns({
        "net_operating_cash_flow": rev - (cogs + opex + F.col("outflow_interest_final") + F.col("outflow_taxes_final")),
        "net_investing_cash_flow": -F.coalesce(F.col("_capex"), F.lit(0.0)),
        "net_financing_cash_flow": F.coalesce(netfin, F.lit(0.0)),
    })
    legs = [F.col(c) for c in ("net_operating_cash_flow", "net_investing_cash_flow", "net_financing_cash_flow")]
    if null_as_zero:
        legs = [F.coalesce(c, F.lit(0.0)) for c in legs]
    df = df.withColumn("net_change_in_cash_total", legs[0] + legs[1] + legs[2])
    return df.select(*keys, ds, *OUT)


def elasticity_overlay(components: DataFrame, base_ind: DataFrame, alt_ind: DataFrame, keys: Sequence[str] = (),
                       ds: str = "ds", activity: str = "economic_activity_index",
                       confidence: str = "consumer_confidence_index", cost: str = "ev_component_cost_index") -> DataFrame:
    """D-18: revenue_final x (1 + 0.6 x activity change + 0.4 x confidence
    change) where the revenue actual is missing; changes are (alt - base) /
    base per period, missing = 0. The cost change is computed and returned
    (``cost_pct_delta``) but, as in the reference, not applied (G17)."""
    keys = list(keys)
    ik = [k for k in keys if k in base_ind.columns and k in alt_ind.columns]
    b = base_ind.select(*ik, ds, *[F.col(c).alias(f"{c}_base") for c in (activity, confidence, cost)])
    a = alt_ind.select(*ik, ds, *[F.col(c).alias(f"{c}_alt") for c in (activity, confidence, cost)])
    ind = b.join(a, ik + [ds], "inner").select(
        *ik, ds,
        F.try_divide(F.col(f"{activity}_alt") - F.col(f"{activity}_base"), F.col(f"{activity}_base")).alias("activity_pct_delta"),
        F.try_divide(F.col(f"{confidence}_alt") - F.col(f"{confidence}_base"), F.col(f"{confidence}_base")).alias("confidence_pct_delta"),
        F.try_divide(F.col(f"{cost}_alt") - F.col(f"{cost}_base"), F.col(f"{cost}_base")).alias("cost_pct_delta"))
    df = merge_actuals_and_forecasts(components).join(ind, ik + [ds], "left")
    adj = F.lit(1.0) + (F.lit(ELASTICITY_ACTIVITY) * F.coalesce("activity_pct_delta", F.lit(0.0))
                        + F.lit(ELASTICITY_CONFIDENCE) * F.coalesce("confidence_pct_delta", F.lit(0.0)))
    return df.withColumn("inflow_operating_revenue_final",
                         F.when(F.col("inflow_operating_revenue_actual").isNull(),
                                F.col("inflow_operating_revenue_final") * adj)
                         .otherwise(F.col("inflow_operating_revenue_final")))


def compare_scenarios(base: DataFrame, alt: DataFrame, value: str = "net_change_in_cash_total",
                      keys: Sequence[str] = (), ds: str = "ds", window: tuple[str, str] | None = None) -> DataFrame:
    """D-19: full outer join of two scenario tables on (keys, ds): base and
    alternative value, delta, delta relative to |base| and the in-window flag."""
    keys = list(keys)
    b = base.select(*keys, ds, F.col(value).alias("base_value"))
    a = alt.select(*keys, ds, F.col(value).alias("alt_value"))
    j = b.join(a, keys + [ds], "full_outer")
    j = j.withColumn("delta", F.col("alt_value") - F.col("base_value"))
    j = j.withColumn("pct_delta", F.try_divide(F.col("delta"), F.abs(F.col("base_value"))))
    if window:
        j = j.withColumn("in_window", (F.col(ds) >= F.lit(window[0]).cast("date"))
                         & (F.col(ds) <= F.lit(window[1]).cast("date")))
    return j


def scenario_totals(comparison: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per-entity totals of both scenarios, as exact sums."""
    return comparison.groupBy(*keys).agg(exact_sum("base_value").alias("base_total"), exact_sum("alt_value").alias("alt_total"))
