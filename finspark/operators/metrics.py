"""Holdout metrics and the blind backtest (D-15, D-16; R-49 .. R-52, R-59).

Errors are averaged per (keys, component) with exact sums, so the doubles do
not depend on partitioning and no group is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import exact_mean
from .joins import attach_scalars

# Backtest verdict bands on MAPE (as a fraction) and their labels.
VERDICT_BANDS = ((0.10, "EXCELLENT"), (0.20, "ACCEPTABLE"))
VERDICT_ELSE = "VOLATILE"
MAPE_EPS = 2.220446049250313e-16


def _err_aggs(y: Column, yhat: Column, pct: bool = True) -> list[Column]:
    e = y - yhat
    aggs = [
        F.count(F.when(y.isNotNull() & yhat.isNotNull(), F.lit(1))).alias("n"),
        exact_mean(F.abs(e)).alias("mae"),
        F.sqrt(exact_mean(e * e)).alias("rmse"),
    ]
    if pct:
        # R-51: zero actuals are skipped (null ratio), result x 100.
        aggs.append((exact_mean(F.abs(F.try_divide(e, y))) * F.lit(100.0)).alias("mape"))
    return aggs


def holdout_metrics(df: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", yhat: str = "yhat",
                    n: int = 6) -> DataFrame:
    """D-15: MAE, RMSE and MAPE (%) of ``yhat`` against ``y`` over the last
    ``n`` rows of each group (R-59 positional holdout)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    h = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return h.groupBy(*keys).agg(*_err_aggs(F.col(y), F.col(yhat)))


def mape_fraction(y: Column, yhat: Column) -> Column:
    """R-52: mean(|y - yhat| / max(|y|, eps)) (library form, a fraction)."""
    return exact_mean(F.abs(y - yhat) / F.greatest(F.abs(y), F.lit(MAPE_EPS)))


def verdict(mape: Column) -> Column:
    out = F.lit(VERDICT_ELSE)
    for bound, label in reversed(VERDICT_BANDS):
        out = F.when(mape < F.lit(bound), F.lit(label)).otherwise(out)
    return out


def backtest(df: DataFrame, keys: Sequence[str], cutoff: str, ds: str = "ds", y: str = "y",
             yhat: str = "yhat") -> DataFrame:
    """D-16: score predictions on the rows at or after ``cutoff`` (train rows
    are before it): rows, MAPE fraction and the verdict band."""
    keys = list(keys)
    t = df.filter(F.col(ds) >= F.lit(cutoff).cast("date")).filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    m = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_test"),
                             mape_fraction(F.col(y), F.col(yhat)).alias("mape"))
    return m.withColumn("verdict", verdict(F.col("mape")))


def scaled_truth(series: DataFrame, keys: Sequence[str], value: str, scale: Column | float, cutoff: str,
                 ds: str = "ds", window: int = 12, out: str = "y") -> DataFrame:
    """Backtest truth: a market series rescaled so the mean of its last
    ``window`` training months equals ``scale`` (G16)."""
    keys = list(keys)
    train = series.filter(F.col(ds) < F.lit(cutoff).cast("date"))
    w = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    base = (train.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= window)
            .groupBy(*keys).agg(exact_mean(F.col(value)).alias("_base")))
    sc = scale if isinstance(scale, Column) else F.lit(float(scale))
    j = series.join(base, keys, "inner") if keys else attach_scalars(series, base)
    return j.withColumn(out, F.col(value) * F.try_divide(sc, F.col("_base"))).drop("_base")
