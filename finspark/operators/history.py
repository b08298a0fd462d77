"""Calibration and synthetic history (D-24, D-25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import exact_mean
from ..functions.expr import dmean, portable_noise
from .joins import attach_scalars

# Fallbacks when no actual history exists (revenue scale, cogs ratio, opex ratio).
FALLBACK_REVENUE = 500_000_000.0
FALLBACK_COGS_RATIO = 0.65
FALLBACK_OPEX_RATIO = 0.15
# Relative noise of synthetic revenue and the seed.
NOISE_STD = 0.02
NOISE_SEED = 42


def calibrate(actual: DataFrame, keys: Sequence[str] = (), ds: str = "ds", n: int = 12,
              revenue: str = "inflow_operating_revenue", cogs: str = "outflow_cogs",
              opex: str = "outflow_opex", which: str = "first") -> DataFrame:
    """D-24: per entity, over its first (or last) ``n`` months: mean revenue,
    mean cogs/revenue and mean opex/revenue. Missing cost columns fall back
    to the default ratios."""
    keys = list(keys)
    o = F.col(ds).asc() if which == "first" else F.col(ds).desc()
    w = Window.partitionBy(*keys).orderBy(o)
    head = actual.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    rev = F.col(revenue).cast("double")

    def ratio(c: str, fallback: float) -> Column:
        if c not in actual.columns:
            return F.lit(fallback)
        return exact_mean(F.try_divide(F.col(c).cast("double"), rev))

    return head.groupBy(*keys).agg(
        dmean(rev).alias("avg_revenue"),
        ratio(cogs, FALLBACK_COGS_RATIO).alias("avg_cogs_ratio"),
        ratio(opex, FALLBACK_OPEX_RATIO).alias("avg_opex_ratio"),
        F.count(F.lit(1)).alias("n_months"),
    )


def synthetic_history(macro: DataFrame, calib: DataFrame | None, keys: Sequence[str] = (), ds: str = "ds",
                      sales: str = "total_vehicle_sales", cpi: str = "cpi",
                      passthrough: Sequence[str] = (), noise_std: float = NOISE_STD,
                      seed: int = NOISE_SEED, market_window: int = 12) -> DataFrame:
    """D-25: revenue = sales x scale / mean(last ``market_window`` sales) x
    (1 + noise_std x N(0,1)); cost index = CPI; cogs = revenue x cogs ratio
    x CPI / mean(CPI); opex = revenue x opex ratio.

    ``calib`` is the output of :func:`calibrate` (per ``keys``); without it
    the fallbacks apply. Noise is drawn from a hash of (keys, ds,
    seed): reruns, retried tasks and other engines draw the same values."""
    keys = list(keys)
    w_last = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    m = macro.withColumn("_rn", F.row_number().over(w_last))
    # Exact sums: the means do not depend on partitioning.
    stats = m.groupBy(*keys).agg(
        exact_mean(F.when(F.col("_rn") <= market_window, F.col(sales).cast("double"))).alias("_market"),
        exact_mean(F.col(cpi).cast("double")).alias("_cpi_mean"))
    x = m.drop("_rn").join(stats, keys, "inner") if keys else attach_scalars(m.drop("_rn"), stats)
    if calib is not None:
        c = calib.select(*keys, "avg_revenue", "avg_cogs_ratio", "avg_opex_ratio")
        x = x.join(c, keys, "left") if keys else attach_scalars(x, c)
    else:
        x = x.withColumns({"avg_revenue": F.lit(None).cast("double"), "avg_cogs_ratio": F.lit(None).cast("double"),
                           "avg_opex_ratio": F.lit(None).cast("double")})
    scale = F.coalesce(F.col("avg_revenue"), F.lit(FALLBACK_REVENUE))
    r_cogs = F.coalesce(F.col("avg_cogs_ratio"), F.lit(FALLBACK_COGS_RATIO))
    r_opex = F.coalesce(F.col("avg_opex_ratio"), F.lit(FALLBACK_OPEX_RATIO))
    z = portable_noise(seed, *keys, ds) if noise_std else F.lit(0.0)
    rev = (F.col(sales).cast("double") * F.try_divide(scale, F.col("_market"))
           * (F.lit(1.0) + F.lit(float(noise_std)) * z))
    x = x.withColumn("inflow_operating_revenue", rev)
    x = x.withColumns({
        "ev_component_cost_index": F.col(cpi).cast("double"),
        "outflow_cogs": F.col("inflow_operating_revenue") * r_cogs * F.try_divide(F.col(cpi), F.col("_cpi_mean")),
        "outflow_opex": F.col("inflow_operating_revenue") * r_opex,
    })
    return x.select(*keys, ds, "inflow_operating_revenue", "outflow_cogs", "outflow_opex",
                    "ev_component_cost_index", *passthrough)
