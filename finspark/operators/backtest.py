"""Blind backtest of the driver model against the rescaled market (D-16).

The model is fitted on each series' history before the cutoff; months from
the cutoff on are predicted with the drivers as they turned out and scored
against the truth. History at or after the cutoff is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .forecast import fit_forecast, predict_forecast
from .metrics import backtest


def backtest_model(history: DataFrame, truth: DataFrame, drivers_df: DataFrame, keys: Sequence[str], cutoff: str,
                   drivers: Sequence[str], ds: str = "ds", y: str = "y", driver_keys: Sequence[str] | None = None,
                   **fit) -> tuple[DataFrame, DataFrame]:
    """(verdicts, predictions). ``history`` has keys, ``ds`` and ``y``;
    ``truth`` the same for the months to score; ``drivers_df`` the drivers by
    (``driver_keys``, ``ds``), default the series' keys. A training month
    without its drivers is left out of the fit, a test month without them is
    not scored; a series that is too short to fit has no verdict."""
    keys, drivers = list(keys), list(drivers)
    on = [*(keys if driver_keys is None else driver_keys), ds]
    known = drivers_df.select(*on, *drivers).na.drop(subset=drivers)
    cut = F.lit(cutoff).cast("date")
    # Read by the scaling statistics and by the fit.
    train = materialize(history.filter(F.col(ds) < cut).select(*keys, ds, y).join(known, on), "backtest_train")
    model = materialize(fit_forecast(train, keys, ds, y, drivers, holdout=0, **fit), "backtest_model")
    months = truth.filter(F.col(ds) >= cut).select(*keys, ds, y).join(known, on)
    predicted = predict_forecast(months, model, keys, ds, drivers, y=y)
    predicted = materialize(predicted.select(*keys, ds, F.col("actual").alias(y), "yhat", "yhat_lower", "yhat_upper"), "backtest")
    inside = F.avg(F.when(F.col(y).between(F.col("yhat_lower"), F.col("yhat_upper")), F.lit(1.0)).when(F.col("yhat_lower").isNotNull(), F.lit(0.0)))
    cover = predicted.groupBy(*keys).agg(inside.alias("inside_bounds"))
    return backtest(predicted, keys, cutoff, ds, y).join(cover, keys, "left"), predicted
