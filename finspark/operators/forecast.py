"""Driver-based seasonal forecasts for many series at once (D-14).

Model per series (``keys`` + component), fitted on the training rows:

    f(y) = a + b t + sum_k (s_k sin + c_k cos)(2 pi k doy / 365.25) + sum_r g_r z_r

with ``f = log`` (multiplicative season and driver effects) when every
training value is positive, else the identity (additive). ``t`` is years
since the series' first training month, ``z_r`` the driver standardised on
the training rows (constant driver -> 0). Ridge penalty on all but (a, b).

Spark plan:
1. per-series statistics (first month, driver mean/std, positivity) as one
   grouped aggregate;
2. the design matrix as column expressions and its Gram matrix
   ``sum(x_i x_j), sum(x_i y), sum(y y)`` as ONE grouped aggregate. The target
   is standardised per series (model scale), and features and target are
   rounded to 4-decimal fixed point (``bigint`` units of 1e-4), so the
   products and sums are exact long arithmetic: the fit does not depend on
   partitioning or task order, stays in codegen (no BigDecimal), and the raw
   rows never leave their executors (partial aggregation);
3. the p x p solve (p = 2 + 2K + R) per series in numpy via ``mapInPandas``
   over the aggregated rows (one small row per series);
4. prediction as a join of the coefficients and a dot-product expression,
   bounds ``exp(eta -/+ z80 sigma)`` (80% interval), where sigma is the
   larger of the in-sample residual sigma and the RMS error of a second fit
   on the last training months it did not see (interval calibration).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import scaled, unscaled
from .calendar import fill_both
from .joins import sized_broadcast

# Fixed-point scale of features and target: units of 10^-DIGITS.
DIGITS = 4
UNIT = float(10 ** DIGITS)
Z80 = 1.2815515655446004
#: Training rows that a target's mean and spread need.
LEAST_ROWS = 2
TWO_PI_OVER_YEAR = 2.0 * math.pi / 365.25


def feature_names(n_season: int, drivers: Sequence[str]) -> list[str]:
    names = ["x_intercept", "x_trend"]
    for k in range(1, n_season + 1):
        names += [f"x_sin{k}", f"x_cos{k}"]
    names += [f"x_{d}" for d in drivers]
    return names


def _month_index(ds: Column) -> Column:
    return F.year(ds) * F.lit(12) + F.month(ds)


def series_stats(train: DataFrame, keys: Sequence[str], ds: str, y: str, drivers: Sequence[str]) -> DataFrame:
    """Per-series first training month, driver mean / std, whether the target
    is strictly positive (log model) and the mean / std of the target on the
    model scale, all on the training rows (one grouped aggregate)."""
    yv = F.col(y).cast("double")
    ly = F.when(yv > 0, F.log(yv))
    aggs = [F.min(_month_index(F.col(ds))).alias("_m0"),
            (F.min(yv) > 0).alias("_multiplicative"),
            F.count(yv).alias("_n_train"),
            F.avg(ly).alias("_mu_log"), F.stddev_samp(ly).alias("_sd_log"),
            F.avg(yv).alias("_mu_lin"), F.stddev_samp(yv).alias("_sd_lin")]
    for d in drivers:
        aggs += [F.avg(F.col(d)).alias(f"_mu_{d}"), F.stddev_samp(F.col(d)).alias(f"_sd_{d}")]
    aggs.append(F.max(F.col(ds)).alias("train_end"))
    st = train.groupBy(*keys).agg(*aggs)
    mult = F.col("_multiplicative")
    sd = F.when(mult, F.col("_sd_log")).otherwise(F.col("_sd_lin"))
    st = st.withColumns({"_ymu": F.coalesce(F.when(mult, F.col("_mu_log")).otherwise(F.col("_mu_lin")), F.lit(0.0)),
                         "_ysd": F.coalesce(F.when(sd > 0, sd), F.lit(1.0))})
    return st.drop("_mu_log", "_sd_log", "_mu_lin", "_sd_lin")


def design(df: DataFrame, stats: DataFrame, keys: Sequence[str], ds: str, drivers: Sequence[str],
           n_season: int = 3) -> DataFrame:
    """Add the feature columns ``x_*`` as 4-decimal fixed point (``bigint``
    units of 1e-4)."""
    keys = list(keys)
    x = df.join(sized_broadcast(stats), keys, "inner")
    d = F.col(ds).cast("date")
    cols = {"x_intercept": F.lit(1.0),
            "x_trend": (_month_index(d) - F.col("_m0")).cast("double") / F.lit(12.0)}
    doy = F.dayofyear(d).cast("double")
    for k in range(1, n_season + 1):
        ang = doy * F.lit(TWO_PI_OVER_YEAR * k)
        cols[f"x_sin{k}"] = F.sin(ang)
        cols[f"x_cos{k}"] = F.cos(ang)
    for r in drivers:
        cols[f"x_{r}"] = F.coalesce(F.try_divide(F.col(r) - F.col(f"_mu_{r}"), F.col(f"_sd_{r}")), F.lit(0.0))
    return x.withColumns({k: scaled(v, DIGITS) for k, v in cols.items()})


def model_target(y: str) -> Column:
    """Model scale: log for multiplicative series, identity otherwise."""
    yv = F.col(y).cast("double")
    return F.when(F.col("_multiplicative"), F.log(yv)).otherwise(yv)


def target_expr(y: str) -> Column:
    """Standardised model-scale target as fixed point (fit input)."""
    return scaled((model_target(y) - F.col("_ymu")) / F.col("_ysd"), DIGITS)


def _gram_aggs(features: Sequence[str], target: str, cond: Column | None = None, prefix: str = "") -> list[Column]:
    f = list(features)
    sq = UNIT * UNIT

    def s2(a: str, b: str) -> Column:
        prod = F.col(a) * F.col(b)
        if cond is not None:
            prod = F.when(cond, prod)
        return F.sum(prod).cast("double") / F.lit(sq)

    n = F.col(target) if cond is None else F.when(cond, F.col(target))
    aggs = [F.count(n).alias(f"{prefix}n")]
    for i in range(len(f)):
        for j in range(i, len(f)):
            aggs.append(s2(f[i], f[j]).alias(f"{prefix}g_{i}_{j}"))
    for i in range(len(f)):
        aggs.append(s2(f[i], target).alias(f"{prefix}xy_{i}"))
    aggs.append(s2(target, target).alias(f"{prefix}yy"))
    return aggs


def gram(x: DataFrame, keys: Sequence[str], features: Sequence[str], target: str = "_t") -> DataFrame:
    """Exact Gram aggregate per series over fixed-point columns:
    ``g_i_j = sum(x_i x_j)`` (i <= j), ``xy_i = sum(x_i t)``, ``yy = sum(t t)``
    (long sums, returned as doubles in natural units) and ``n``."""
    return x.filter(F.col(target).isNotNull()).groupBy(*keys).agg(*_gram_aggs(features, target))


def _solver(keys: Sequence[str], p: int, ridge: float, need: int, unpenalised: int = 2):
    """Per aggregated row: solve the ridge system of all training rows and of
    the early rows (``e_`` sums); the early model's error on the late rows
    comes from the Gram differences (late = all - early), so no second pass
    over the data is needed. Each Arrow batch is solved as one stacked
    ``(m, p, p)`` numpy problem (no per-series Python loop)."""
    iu = np.triu_indices(p)
    pen = np.diag(np.r_[np.zeros(unpenalised), np.full(p - unpenalised, ridge)])

    def unpack(pdf, pre):
        m = len(pdf)
        g = np.zeros((m, p, p))
        for i, j in zip(*iu):
            col = pdf[f"{pre}g_{i}_{j}"].to_numpy(dtype=float)
            g[:, i, j] = col
            g[:, j, i] = col
        b = np.stack([pdf[f"{pre}xy_{i}"].to_numpy(dtype=float) for i in range(p)], axis=1)
        return g, b, pdf[f"{pre}yy"].to_numpy(dtype=float), pdf[f"{pre}n"].to_numpy(dtype=float)

    def solve_all(g, b):
        a = g + pen
        try:
            return np.linalg.solve(a, b[..., None])[..., 0]
        except np.linalg.LinAlgError:
            out = np.empty_like(b)
            for k in range(len(b)):
                try:
                    out[k] = np.linalg.solve(a[k], b[k])
                except np.linalg.LinAlgError:
                    out[k] = np.linalg.lstsq(a[k], b[k], rcond=None)[0]
            return out

    def rss(beta, g, b, yy):
        quad = np.einsum("mi,mij,mj->m", beta, g, beta)
        return np.maximum(yy - 2.0 * np.einsum("mi,mi->m", beta, b) + quad, 0.0)

    def solve(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            g, b, yy, n = unpack(pdf, "")
            beta = solve_all(g, b)
            # no residual is left to estimate a spread from when n <= p
            sigma_in = np.where(n > p, np.sqrt(rss(beta, g, b, yy) / np.maximum(n - p, 1.0)), np.nan)
            sigma_oos = np.full(len(pdf), np.nan)
            if "e_n" in pdf.columns:
                ge, be, yye, ne = unpack(pdf, "e_")
                ok = (ne >= need) & (n - ne > 0)
                if ok.any():
                    beta_e = solve_all(ge[ok], be[ok])
                    late = rss(beta_e, g[ok] - ge[ok], b[ok] - be[ok], yy[ok] - yye[ok])
                    sigma_oos[ok] = np.sqrt(late / (n[ok] - ne[ok]))
            # back from the standardised target to the model scale
            mu, sd = pdf["_ymu"].to_numpy(dtype=float), pdf["_ysd"].to_numpy(dtype=float)
            beta = beta * sd[:, None]
            beta[:, 0] += mu
            out = pdf[list(keys)].copy()
            out["beta"] = list(beta)
            out["sigma_in"] = np.where(np.isnan(sigma_in), None, sigma_in * sd)
            out["sigma_oos"] = np.where(np.isnan(sigma_oos), None, sigma_oos * sd)
            out["n_fit"] = n.astype("int64")
            yield out
    return solve


def _fit_core(train: DataFrame, keys: list[str], ds: str, y: str, drivers: list[str], n_season: int,
              ridge: float, min_rows: int | None, early: Column | None = None) -> DataFrame:
    stats = series_stats(train, keys, ds, y, drivers)
    p = 2 + 2 * n_season + len(drivers)
    need = p + 1  # rows for an out-of-sample check of the fit
    stats = stats.filter(F.col("_n_train") >= max(min_rows or 0, LEAST_ROWS))
    x = design(train, stats, keys, ds, drivers, n_season).withColumn("_t", target_expr(y))
    feats = feature_names(n_season, drivers)
    aggs = _gram_aggs(feats, "_t")
    if early is not None:
        aggs += _gram_aggs(feats, "_t", early, "e_")
    g = x.filter(F.col("_t").isNotNull()).groupBy(*keys).agg(
        *aggs, F.first("_ymu").alias("_ymu"), F.first("_ysd").alias("_ysd"))
    kt = {f.name: f.dataType.simpleString() for f in g.schema.fields if f.name in keys}
    schema = (", ".join(f"{k} {kt[k]}" for k in keys)
              + ", beta array<double>, sigma_in double, sigma_oos double, n_fit long")
    coef = g.mapInPandas(_solver(keys, p, ridge, need), schema)
    return stats.join(coef, keys, "inner")


def _eta(feats: Sequence[str]) -> Column:
    eta = F.lit(0.0)
    for i, f in enumerate(feats):
        eta = eta + (F.col(f).cast("double") / F.lit(UNIT)) * F.element_at("beta", i + 1)
    return eta


def _model_cols(model: DataFrame, keys: Sequence[str]) -> list[str]:
    return list(keys) + [c for c in model.columns
                         if c.startswith("_") or c in ("beta", "sigma", "train_end")]


def fit_forecast(df: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y",
                 drivers: Sequence[str] = (), holdout: int = 6, n_season: int = 3,
                 ridge: float = 0.1, min_rows: int | None = None,
                 interval_calibration: int = 6, null_target: str = "drop") -> DataFrame:
    """Fit one model per series. Training rows: non-null target, all but the
    last ``holdout`` rows of the series (R-59). A series with no more rows
    than the holdout (or fewer training rows than ``min_rows``, or than the
    two that a scale needs) is skipped; :func:`fit_report` lists those. A
    series with no more training rows than terms gets a fit without sigma.

    Interval width: in-sample residuals understate forecast error, so a
    second system, fitted without the last ``interval_calibration`` training
    rows, is scored on them, and the bounds use ``max(in-sample sigma,
    out-of-sample RMS error)`` (model scale). Both systems come from the same
    single Gram aggregate (conditional sums), so this costs no extra pass.
    ``0`` disables the calibration.

    ``null_target='zero'`` fills missing targets with 0 before fitting (the
    multi-component path of the reference; a series that is then all zero, or
    has any value <= 0, is fitted additively); ``'drop'`` ignores them.

    Returns one row per series: keys, statistics, ``beta`` (array in
    :func:`feature_names` order), ``sigma`` (used for the bounds),
    ``sigma_in``, ``sigma_oos``, ``n_fit``, ``train_end``."""
    keys, drivers = list(keys), list(drivers)
    if null_target == "zero":
        obs = df.withColumn(y, F.coalesce(F.col(y).cast("double"), F.lit(0.0)))
    elif null_target == "drop":
        obs = df.filter(F.col(y).isNotNull())
    else:
        raise ValueError(null_target)
    w = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    ranked = obs.withColumn("_rn", F.row_number().over(w))
    train = ranked.filter(F.col("_rn") > holdout)
    early = (F.col("_rn") > holdout + interval_calibration) if interval_calibration > 0 else None
    model = _fit_core(train, keys, ds, y, drivers, n_season, ridge, min_rows, early)
    return model.withColumn("sigma", F.when(F.col("sigma_oos").isNotNull(),
                                            F.greatest("sigma_in", "sigma_oos")).otherwise(F.col("sigma_in")))


def fit_report(df: DataFrame, model: DataFrame, keys: Sequence[str], y: str = "y", null_target: str = "drop") -> DataFrame:
    """One row per series of ``df``: rows with a target, training rows used
    and status - ``fitted``, ``fitted_no_interval`` (too few rows for a
    spread) or ``skipped_too_short``."""
    keys = list(keys)
    n = F.count(F.lit(1)) if null_target == "zero" else F.count(F.col(y))
    rows = df.groupBy(*keys).agg(n.alias("n_rows"))
    out = rows.join(model.select(*keys, "n_fit", "sigma"), keys, "left")
    status = (F.when(F.col("n_fit").isNull(), "skipped_too_short").when(F.col("sigma").isNull(), "fitted_no_interval")
              .otherwise("fitted"))
    return out.select(*keys, "n_rows", F.coalesce("n_fit", F.lit(0).cast("bigint")).alias("n_fit"), status.alias("status"))


def future_frame(history: DataFrame, model: DataFrame, drivers_df: DataFrame | None, keys: Sequence[str],
                 ds: str = "ds", horizon: int = 24, drivers: Sequence[str] = (),
                 driver_keys: Sequence[str] = ()) -> DataFrame:
    """Rows to score: every month from the series' first observation to
    ``train_end + horizon`` months (R-58 spine), with the drivers joined and
    filled forward, then backward, then 0 (R-57)."""
    keys, drivers, dk = list(keys), list(drivers), list(driver_keys)
    rng = history.groupBy(*keys).agg(F.min(ds).alias("_lo")).join(model.select(*keys, "train_end"), keys)
    seq = F.transform(F.sequence(F.trunc("_lo", "MM"),
                                 F.trunc(F.add_months("train_end", horizon), "MM"), F.expr("interval 1 month")),
                      lambda d: F.last_day(d))
    spine = rng.select(*keys, F.explode(seq).alias(ds))
    spine = spine.join(history.select(*keys, ds, *[c for c in history.columns
                                                   if c not in keys and c != ds and c not in drivers]),
                       keys + [ds], "left")
    if drivers_df is not None and drivers:
        spine = spine.join(drivers_df.select(*dk, ds, *drivers), dk + [ds], "left")
        spine = fill_both(spine, keys, ds, drivers, 0.0)
    return spine


def predict_forecast(df: DataFrame, model: DataFrame, keys: Sequence[str], ds: str = "ds",
                     drivers: Sequence[str] = (), n_season: int = 3, y: str | None = "y") -> DataFrame:
    """Score rows with the fitted model: ``yhat``, ``yhat_lower``,
    ``yhat_upper`` (80%), plus ``actual`` when ``y`` is present."""
    keys, drivers = list(keys), list(drivers)
    feats = feature_names(n_season, drivers)
    x = design(df, model.select(*_model_cols(model, keys)), keys, ds, drivers, n_season)
    x = x.withColumn("_eta", _eta(feats))
    lo = F.col("_eta") - F.lit(Z80) * F.col("sigma")
    hi = F.col("_eta") + F.lit(Z80) * F.col("sigma")
    mult = F.col("_multiplicative")
    x = x.withColumns({
        "yhat": F.when(mult, F.exp("_eta")).otherwise(F.col("_eta")),
        "yhat_lower": F.when(mult, F.exp(lo)).otherwise(lo),
        "yhat_upper": F.when(mult, F.exp(hi)).otherwise(hi),
    })
    out = [*keys, ds]
    if y and y in df.columns:
        x = x.withColumn("actual", F.col(y))
        out.append("actual")
    return x.select(*out, "yhat", "yhat_lower", "yhat_upper")


def coefficient_table(model: DataFrame, keys: Sequence[str], drivers: Sequence[str], n_season: int = 3) -> DataFrame:
    """Named coefficients (one row per series and term) instead of an
    unlabelled vector."""
    names = feature_names(n_season, list(drivers))
    arr = F.arrays_zip(F.array(*[F.lit(n[2:]) for n in names]).alias("term"), F.col("beta").alias("coef"))
    return model.select(*keys, F.explode(arr).alias("_c")).select(*keys, "_c.term", "_c.coef")


def linear_trend(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of ``y`` on an integer ``x`` per
    group from exact sums (fixed point for ``y``), so the result does not
    depend on partitioning."""
    keys = list(keys)
    ok = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = ok.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.sum(F.col(x).cast("bigint")).cast("double").alias("_sx"),
        F.sum(F.col(x).cast("bigint") * F.col(x).cast("bigint")).cast("double").alias("_sxx"),
        unscaled(F.sum(scaled(y))).alias("_sy"),
        unscaled(F.sum(scaled(F.col(x).cast("double") * F.col(y)))).alias("_sxy"))
    slope = F.try_divide(F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy"),
                         F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx"))
    s = s.withColumn("slope", slope)
    s = s.withColumn("intercept", (F.col("_sy") - F.col("slope") * F.col("_sx")) / F.col("_n"))
    return s.select(*keys, F.col("_n").cast("bigint").alias("n"), "slope", "intercept")
