"""Calendar spine, resampling and fills (D-26; R-41, R-42, R-54, R-56..R-59).

Shuffle plan: raw rows are first aggregated by ``(keys, period)`` with
map-side partial aggregation (one hot entity collapses to one row per
period before any exchange), then a single exchange by ``keys`` serves every
window of the same ``partitionBy(keys).orderBy(ds)`` family.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dmean, dsum, month_end
from .joins import attach_scalars
from .scans import carry


def period_of(c, freq: str = "month"):
    if freq == "month":
        return month_end(c)
    if freq == "day":
        return F.col(c).cast("date") if isinstance(c, str) else c.cast("date")
    raise ValueError(freq)


def _spine_sequence(lo, hi, freq: str):
    """Periods from ``lo`` to ``hi`` inclusive. Months step from the first of
    the month then snap with ``last_day`` (stepping from the 30th would not
    land on month ends)."""
    if freq == "month":
        seq = F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr("interval 1 month"))
        return F.transform(seq, lambda d: F.last_day(d))
    return F.sequence(lo, hi, F.expr("interval 1 day"))


def calendar_spine(df: DataFrame, keys: Sequence[str], ds: str = "ds", freq: str = "month",
                   bounds: str = "entity", until=None) -> DataFrame:
    """R-58: one row per (keys, period) between the bounds.

    ``bounds='entity'`` spans each entity's own first..last period (pandas
    resample on one series); ``'global'`` spans the overall first..last
    period for every entity (leading gaps stay visible). ``until`` extends
    the end (a date Column or literal), e.g. a forecast horizon.
    Built with ``sequence`` + ``explode`` per entity: no cross join."""
    keys = list(keys)
    if bounds == "entity":
        rng = df.groupBy(*keys).agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi"))
        lo, hi = F.col("_lo"), F.col("_hi")
    elif bounds == "global":
        g = df.agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi"))
        rng = attach_scalars(df.select(*keys).distinct(), g)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        raise ValueError(bounds)
    if until is not None:
        hi = F.greatest(hi, until if not isinstance(until, str) else F.lit(until).cast("date"))
    return rng.select(*keys, F.explode(_spine_sequence(lo, hi, freq)).alias(ds))


def resample(df: DataFrame, keys: Sequence[str], ds: str, values: Sequence[str],
             how: str = "sum", freq: str = "month", bounds: str = "entity",
             exact: bool = True) -> DataFrame:
    """R-41 / R-42: aggregate to the period grain on a full calendar spine.

    ``how='sum'``: empty periods are 0 (pandas ``resample().sum()``);
    ``how='mean'``: empty periods are null. With ``exact`` the sums run in
    exact fixed point so results do not depend on partitioning (G9).

    The source is aggregated to its periods first, in one scan; each row then
    generates the periods up to the next one, so gaps need no spine to join."""
    keys = list(keys)
    if how not in ("sum", "mean"):
        raise ValueError(how)
    if bounds not in ("entity", "global"):
        raise ValueError(bounds)
    agg = {("sum", True): dsum, ("sum", False): F.sum, ("mean", True): dmean, ("mean", False): F.avg}[how, exact]
    per = df.select(*keys, period_of(ds, freq).alias(ds), *values).groupBy(*keys, ds).agg(*[agg(v).alias(v) for v in values])
    per = per.filter(F.col(ds).isNotNull())
    w = _w(keys, ds)
    nxt = F.lead(ds).over(w)
    lo, hi = F.col(ds), F.coalesce(F.last_day(F.add_months(nxt, -1)) if freq == "month" else F.date_sub(nxt, 1), F.col(ds))
    if bounds == "global":
        per = attach_scalars(per, per.agg(F.min(ds).alias("_lo"), F.max(ds).alias("_hi")))
        lo = F.when(F.lag(ds).over(w).isNull(), F.col("_lo")).otherwise(lo)
        hi = F.when(nxt.isNull(), F.col("_hi")).otherwise(hi)
    rows = per.withColumns({"_from": lo, "_to": hi}).withColumn(
        "_p", F.explode(_spine_sequence(F.col("_from"), F.col("_to"), freq)))
    empty = F.lit(0.0 if how == "sum" else None).cast("double")
    own = [F.when(F.col("_p") == F.col(ds), F.coalesce(v, empty)).otherwise(empty).alias(v) for v in values]
    return rows.select(*keys, F.col("_p").alias(ds), *own)


def _w(keys: Sequence[str], order: str | Sequence[str]):
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def _orders(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def fill_forward(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str], hot: bool = False) -> DataFrame:
    """R-56: last non-null value up to the current row, per entity."""
    if hot or not keys:
        return carry(df, keys, _orders(order), forward={c: c for c in cols})
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def fill_backward(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str], hot: bool = False) -> DataFrame:
    """The next non-null value: the last one in descending order, so the
    frame only grows (one pass) instead of being rebuilt for each row."""
    if hot or not keys:
        return carry(df, keys, _orders(order), backward={c: c for c in cols})
    w = _backwards(keys, order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def _backwards(keys: Sequence[str], order: str | Sequence[str]):
    return (Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in _orders(order)])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def fill_both(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str],
              default: float = 0.0, hot: bool = False) -> DataFrame:
    """R-57: forward fill, then backward fill, then a constant."""
    if hot or not keys:
        behind = {f"_behind_{c}": c for c in cols}
        out = carry(df, keys, _orders(order), forward={c: c for c in cols}, backward=behind)
        return out.withColumns({c: F.coalesce(c, f"_behind_{c}", F.lit(default)) for c in cols}).drop(*behind)
    wf = _w(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wb = _backwards(keys, order)
    return df.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(wf), F.last(c, ignorenulls=True).over(wb),
                      F.lit(default))
        for c in cols})


def diff_prev(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], col: str, out: str, hot: bool = False) -> DataFrame:
    """R-54: ``x - previous x`` per entity; the first row (and a missing side,
    as pandas ``diff().fillna(0)``) gives 0."""
    if hot or not keys:
        x = carry(df, keys, _orders(order), previous={"_before": col})
        return x.withColumn(out, F.coalesce(F.col(col) - F.col("_before"), F.lit(0.0))).drop("_before")
    w = _w(keys, order)
    return df.withColumn(out, F.coalesce(F.col(col) - F.lag(col).over(w), F.lit(0.0)))


def holdout_flag(df: DataFrame, keys: Sequence[str], order: str, n: int,
                 out: str = "is_holdout") -> DataFrame:
    """R-59: the last ``n`` rows of each entity are the holdout."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn(out, F.row_number().over(w) <= F.lit(n))
