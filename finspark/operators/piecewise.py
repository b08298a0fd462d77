"""Piecewise trends and bounds by lead month for many series (D-14).

:mod:`forecast` fits one straight trend and one width of the bounds. Here the
trend may bend at ``n_breaks`` candidate months, evenly spaced over the first
``span`` of a series' training months, and the bounds widen with the distance
to the last known month as the model's own errors did.

Both come from ONE grouped aggregate: the Gram sums of the straight design,
by series and *bucket* of consecutive months, where buckets end at candidate
breaks and at the origins of the rolling check. Its prefix sums (``n_breaks +
origins + 1`` small rows a series at most) hold all that follows:

* a hinge ``max(t - c, 0)`` times any feature sums to ``sum(t x) - c sum(x)``
  over the rows after ``c``, so hinge columns are never formed from rows;
* the rows before an origin are a prefix, so a model as of every origin is
  fitted without another pass, and its squared errors in the blocks of
  ``step`` months behind it are quadratic forms in those blocks' sums.

Per series the slopes' changes get an L1 penalty: the other terms are
eliminated exactly (a Schur complement), coordinate descent runs on the small
remaining system for all series of an Arrow batch at once, and the changes
that stay are fitted again without the penalty's shrinkage. The variance at
lead ``h`` is ``var_0 + var_1 h``, least squares with both at least 0 over
the errors of all origins and blocks.

A series needs as many training rows as the straight model has terms and one
more to get breaks or bounds by lead; shorter ones keep a straight trend and
the in-sample spread (or none, as in :mod:`forecast`).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import scaled
from . import forecast as fc

#: Rows of series that are solved as one stacked problem.
STACK = 500


def break_months(n_months: Column, n_breaks: int, span: float) -> Column:
    """Candidate breaks as months since the first training month: distinct,
    after the first and before the last month."""
    last = F.floor((n_months - F.lit(1)) * F.lit(float(span)))
    all_of = F.transform(F.sequence(F.lit(1), F.lit(n_breaks)), lambda j: F.floor(j * last / F.lit(n_breaks)).cast("int"))
    return F.array_sort(F.array_distinct(F.filter(all_of, lambda c: (c > 0) & (c < n_months - 1))))


def origin_months(n_months: Column, origins: int, step: int) -> Column:
    """Months since the first one before which the rolling models end."""
    back = F.transform(F.sequence(F.lit(1), F.lit(origins)), lambda j: (n_months - j * F.lit(step)).cast("int"))
    return F.array_sort(F.filter(back, lambda c: c > 1))


def segment_gram(train: DataFrame, keys: Sequence[str], ds: str, y: str, drivers: Sequence[str], n_season: int = 3,
                 n_breaks: int = 12, span: float = 0.8, origins: int = 8, step: int = 3,
                 min_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(statistics of every series with its ``breaks`` and ``origins``, exact
    Gram sums by series and bucket). Bucket b holds the months m with b of
    the series' bounds (break: months up to and with it; origin: months
    before it) below m."""
    keys, drivers = list(keys), list(drivers)
    d = F.col(ds).cast("date")
    month = F.year(d) * F.lit(12) + F.month(d)
    ends = train.groupBy(*keys).agg(F.max(month).alias("_m1"))
    stats = fc.series_stats(train, keys, ds, y, drivers).join(ends, keys)
    stats = stats.filter(F.col("_n_train") >= max(min_rows or 0, fc.LEAST_ROWS))
    # A series that can't bear more terms has no bounds but its end.
    p = 2 + 2 * n_season + len(drivers)
    n = (F.col("_m1") - F.col("_m0") + F.lit(1)).cast("int")
    none = F.array().cast("array<int>")
    enough = F.col("_n_train") > F.lit(p)
    stats = stats.withColumns({"breaks": F.when(enough, break_months(n, n_breaks, span)).otherwise(none) if n_breaks else none,
                               "origins": F.when(enough, origin_months(n, origins, step)).otherwise(none) if origins else none})
    # Months up to a break belong before it, months up to the one before an origin too.
    bounds = F.array_sort(F.array_distinct(F.concat("breaks", F.transform("origins", lambda o: o - F.lit(1)))))
    stats = stats.withColumn("_bounds", bounds)
    x = fc.design(train, stats, keys, ds, drivers, n_season).withColumn("_t", fc.target_expr(y))
    at = (F.year(d) * F.lit(12) + F.month(d) - F.col("_m0")).cast("int")
    x = x.withColumn("bucket", F.size(F.filter("_bounds", lambda b: b < at)))
    feats = fc.feature_names(n_season, drivers)
    return stats, fc.gram(x, [*keys, "bucket"], feats)


def hinge_sums(segments: DataFrame, stats: DataFrame, keys: Sequence[str], n_features: int) -> DataFrame:
    """One row per series and candidate break: the sums of the hinge column
    over the rows after the break - with every feature (``hx_i``), the target
    (``hy``) and itself (``hh``) - from suffix sums of the buckets alone."""
    keys = list(keys)
    brk = stats.select(*keys, "_bounds", F.explode("breaks").alias("break_month"))
    after = F.size(F.filter("_bounds", lambda b: b < F.col("break_month"))) + F.lit(1)
    brk = brk.withColumn("_from", after)
    j = segments.join(brk, keys).filter(F.col("bucket") >= F.col("_from"))
    unit = F.lit(fc.UNIT)
    # the break on the trend's own fixed point, so hinges are exact differences
    c = F.floor(F.col("break_month") / F.lit(12.0) * unit + F.lit(0.5)).cast("bigint")

    def total(col: str) -> Column:  # back to exact long units
        return F.sum(F.round(F.col(col) * unit * unit).cast("bigint"))

    def g(i: int, k: int) -> str:
        return f"g_{min(i, k)}_{max(i, k)}"

    agg = {f"_s{i}": total(g(0, i)) for i in range(n_features)} | {f"_t{i}": total(g(1, i)) for i in range(n_features)}
    agg |= {"_sy": total("xy_0"), "_ty": total("xy_1")}
    s = j.groupBy(*keys, "break_month").agg(F.sum("n").alias("n_after"), *[v.alias(k) for k, v in agg.items()])

    def of(ts: str, ones: str) -> Column:  # sum(t x) - c sum(x), where sum(x) holds the intercept's unit
        return ((F.col(ts) - c * F.expr(f"{ones} div {int(fc.UNIT)}")).cast("double") / (unit * unit))

    out = [F.col("n_after"), *[of(f"_t{i}", f"_s{i}").alias(f"hx_{i}") for i in range(n_features)], of("_ty", "_sy").alias("hy")]
    hh = (F.col("_t1") - F.lit(2) * c * F.expr(f"_s1 div {int(fc.UNIT)}")
          + c * c * F.col("n_after")).cast("double") / (unit * unit)
    return s.select(*keys, "break_month", *out, hh.alias("hh"))


# --- the solve, over stacked series ----------------------------------------

def prefix_grams(rows: list, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the augmented Gram, whose last column is the target,
    (series, bucket + 1, p + 1, p + 1), and of the row counts."""
    most = max((b["bucket"] for r in rows for b in r), default=0) + 1
    out = np.zeros((len(rows), most + 1, p + 1, p + 1))
    n = np.zeros((len(rows), most + 1))
    iu = np.triu_indices(p)
    for k, r in enumerate(rows):
        for b in r:
            s = np.asarray(b["sums"], float)
            m = np.zeros((p + 1, p + 1))
            m[iu] = s[:len(iu[0])]
            m[:p, p] = s[len(iu[0]):-2]
            m = np.triu(m) + np.triu(m, 1).T
            m[p, p] = s[-2]
            out[k, b["bucket"] + 1] = m
            n[k, b["bucket"] + 1] = s[-1]
    return np.cumsum(out, axis=1), np.cumsum(n, axis=1)


def with_hinges(prefix: np.ndarray, upto: np.ndarray, at: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The augmented Gram (features, hinges, target) of the rows in the first
    ``upto`` buckets. ``at``: buckets before each break (m, h); ``c``: breaks
    in years, nan where a series has fewer."""
    m, _, q, _ = prefix.shape
    p, h = q - 1, c.shape[1]
    whole = prefix[np.arange(m), upto]
    out = np.zeros((m, p + h + 1, p + h + 1))
    out[:, :p, :p] = whole[:, :p, :p]
    out[:, :p, -1] = out[:, -1, :p] = whole[:, :p, p]
    out[:, -1, -1] = whole[:, p, p]
    used = ~np.isnan(c) & (at < upto[:, None])
    c0 = np.nan_to_num(c)
    tail = [whole - prefix[np.arange(m), np.minimum(at[:, j], upto)] for j in range(h)]
    for j in range(h):
        d, cj, on = tail[j], c0[:, j, None], used[:, j]
        row = np.where(on[:, None], d[:, 1, :] - cj * d[:, 0, :], 0.0)
        out[:, p + j, :p] = out[:, :p, p + j] = row[:, :p]
        out[:, p + j, -1] = out[:, -1, p + j] = row[:, p]
        for i in range(j + 1):  # breaks ascend: rows after c_j are after c_i too
            s = c0[:, i] + c0[:, j]
            v = d[:, 1, 1] - s * d[:, 0, 1] + c0[:, i] * c0[:, j] * d[:, 0, 0]
            out[:, p + j, p + i] = out[:, p + i, p + j] = np.where(on & used[:, i], v, 0.0)
    return out


def l1_path(a: np.ndarray, b: np.ndarray, lam: np.ndarray, rounds: int = 2000, tol: float = 1e-9) -> np.ndarray:
    """Coordinate descent for 1/2 d'Ad - b'd + lam |d|_1, stacked (m, h)."""
    m, h = b.shape
    d = np.zeros((m, h))
    diag = np.einsum("mii->mi", a)
    # a column that is (nearly) a combination of the eliminated ones says nothing
    on = diag > 1e-9 * np.maximum(diag.max(axis=1, keepdims=True, initial=0.0), 1e-12)
    grad = b.copy()  # b - A d
    for _ in range(rounds):
        most = 0.0
        for j in range(h):
            z = grad[:, j] + diag[:, j] * d[:, j]
            new = np.where(on[:, j], np.sign(z) * np.maximum(np.abs(z) - lam, 0.0) / np.where(on[:, j], diag[:, j], 1.0), 0.0)
            step = new - d[:, j]
            if step.any():
                grad -= a[:, :, j] * step[:, None]
                d[:, j] = new
                most = max(most, float(np.abs(step).max()))
        if most < tol:
            break
    return d


def solve_stack(gram: np.ndarray, n: np.ndarray, p: int, ridge: float, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """(beta of features and hinges, residual sum of squares), stacked. The
    hinges' L1 weight is the residual variance over ``prior``; hinges that
    stay are fitted again with the features."""
    m, q, _ = gram.shape
    h = q - 1 - p
    pen = np.diag(np.r_[np.zeros(2), np.full(p - 2, ridge), np.full(h, 1e-9)])

    def fit(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.concatenate([np.ones((m, p), bool), on], axis=1)
        a = np.where(mask[:, :, None] & mask[:, None, :], gram[:, :-1, :-1] + pen, 0.0)
        a += np.where(mask, 0.0, 1.0)[:, :, None] * np.eye(p + h)
        b = np.where(mask, gram[:, :-1, -1], 0.0)
        try:
            beta = np.linalg.solve(a, b[..., None])[..., 0]
        except np.linalg.LinAlgError:
            beta = np.stack([np.linalg.lstsq(x, y, rcond=None)[0] for x, y in zip(a, b)])
        rss = (gram[:, -1, -1] - 2 * np.einsum("mi,mi->m", beta, gram[:, :-1, -1])
               + np.einsum("mi,mij,mj->m", beta, gram[:, :-1, :-1], beta))
        return beta, np.maximum(rss, 0.0)

    if not h:
        return fit(np.zeros((m, 0), bool))
    diag = np.einsum("mii->mi", gram)[:, p:p + h]
    live = diag > 0
    _, rss = fit(live)
    left = np.maximum(n - p - live.sum(axis=1), 1.0)
    lam = rss / left / prior
    smooth = gram[:, :p, :p] + pen[:p, :p] + 1e-12 * np.eye(p)
    cross = np.concatenate([gram[:, :p, p:p + h], gram[:, :p, -1:]], axis=2)
    try:
        done = np.linalg.solve(smooth, cross)
    except np.linalg.LinAlgError:
        done = np.stack([np.linalg.lstsq(x, y, rcond=None)[0] for x, y in zip(smooth, cross)])
    reduced = np.swapaxes(cross[:, :, :h], 1, 2) @ done
    a, b = gram[:, p:p + h, p:p + h] - reduced[:, :, :h], gram[:, p:p + h, -1] - reduced[:, :, h]
    chosen = l1_path(a, b, lam) != 0.0
    # enough rows for what is fitted without a penalty
    chosen &= (n > p + chosen.sum(axis=1))[:, None]
    return fit(chosen)


def lead_variance(errors: list[tuple[float, float, float]]) -> tuple[float, float]:
    """(var_0, var_1) at least 0 of variance = var_0 + var_1 lead, least
    squares over (lead, mean squared error, weight)."""
    if not errors:
        return float("nan"), float("nan")
    h, e, w = np.array(errors, float).T
    mh, me = np.average(h, weights=w), np.average(e, weights=w)
    spread = np.average((h - mh) ** 2, weights=w)
    slope = np.average((h - mh) * (e - me), weights=w) / spread if spread > 0 else 0.0
    if slope <= 0:
        return float(me), 0.0
    if me - slope * mh < 0:
        return 0.0, float(np.average(h * e, weights=w) / np.average(h * h, weights=w))
    return float(me - slope * mh), float(slope)


def _solve(keys: Sequence[str], p: int, ridge: float, prior: float, step: int):
    def stack(pdf):
        rows = list(pdf["segments"])
        breaks = [np.asarray(b, float) for b in pdf["breaks"]]
        bounds = [np.asarray(b, int) for b in pdf["_bounds"]]
        origins = [np.asarray(o, int) for o in pdf["origins"]]
        prefix, count = prefix_grams(rows, p)
        m, h, most = len(rows), max(map(len, breaks), default=0), prefix.shape[1] - 1
        c, at = np.full((m, h), np.nan), np.zeros((m, h), int)
        for k, b in enumerate(breaks):
            c[k, :len(b)] = np.floor(b / 12.0 * fc.UNIT + 0.5) / fc.UNIT
            at[k, :len(b)] = np.minimum(np.searchsorted(bounds[k], b) + 1, most)
        every = np.full(m, most)
        n = count[np.arange(m), every]
        gram = with_hinges(prefix, every, at, c)
        beta, rss = solve_stack(gram, n, p, ridge, prior)
        terms = p + (beta[:, p:] != 0).sum(axis=1)
        sigma = np.where(n > terms, np.sqrt(rss / np.maximum(n - terms, 1.0)), np.nan)
        # Models as of each origin, and their errors in the blocks behind it.
        errors: list[list] = [[] for _ in range(m)]
        deepest = max(map(len, origins), default=0)
        for o in range(deepest):
            own = np.array([k for k in range(m) if o < len(origins[k])])
            first = np.array([int(np.searchsorted(bounds[k], origins[k][o] - 1)) + 1 for k in own])
            first = np.minimum(first, most)
            known = count[own, first]
            enough = known > p
            own, first, known = own[enough], first[enough], known[enough]
            if not len(own):
                continue
            b_o, _ = solve_stack(with_hinges(prefix[own], first, at[own], c[own]), known, p, ridge, prior)
            for later in range(o, deepest):
                ends = [min(int(np.searchsorted(bounds[k], origins[k][later + 1] - 1)) + 1, most) if later + 1 < len(origins[k]) else most
                        for k in own]
                begins = [min(int(np.searchsorted(bounds[k], origins[k][later] - 1)) + 1, most) if later < len(origins[k]) else most
                          for k in own]
                late = (with_hinges(prefix[own], np.array(ends), at[own], c[own])
                        - with_hinges(prefix[own], np.array(begins), at[own], c[own]))
                rows_in = count[own, ends] - count[own, begins]
                sq = (late[:, -1, -1] - 2 * np.einsum("mi,mi->m", b_o, late[:, :-1, -1])
                      + np.einsum("mi,mij,mj->m", b_o, late[:, :-1, :-1], b_o))
                for i, k in enumerate(own):
                    if rows_in[i] > 0 and later < len(origins[k]):
                        lead = origins[k][later] - origins[k][o] + (step + 1) / 2
                        errors[k].append((lead, max(float(sq[i]) / rows_in[i], 0.0), rows_in[i]))
        mu, sd = pdf["_ymu"].to_numpy(float), pdf["_ysd"].to_numpy(float)
        out = pdf[list(keys)].copy()
        scaled_beta = beta * sd[:, None]
        scaled_beta[:, 0] += mu
        out["beta"] = [list(b[:p]) for b in scaled_beta]
        out["break_at"] = [[float(x) for x, d in zip(c[k], b[p:]) if d != 0] for k, b in enumerate(scaled_beta)]
        out["slope_change"] = [[float(d) for d in b[p:] if d != 0] for b in scaled_beta]
        out["sigma_in"] = [None if np.isnan(s) else float(s * z) for s, z in zip(sigma, sd)]
        var = [lead_variance(e) for e in errors]
        out["var_0"] = [None if np.isnan(a) else a * z * z for (a, _), z in zip(var, sd)]
        out["var_1"] = [None if np.isnan(b) else b * z * z for (_, b), z in zip(var, sd)]
        out["n_fit"] = n.astype("int64")
        return out

    def run(batches):
        for pdf in batches:
            for k in range(0, len(pdf), STACK):
                yield stack(pdf.iloc[k:k + STACK].reset_index(drop=True))

    return run


def fit_piecewise(df: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", drivers: Sequence[str] = (),
                  holdout: int = 6, n_season: int = 3, ridge: float = 0.1, n_breaks: int = 12, span: float = 0.8,
                  prior: float = 0.05, origins: int = 8, step: int = 3, min_rows: int | None = None) -> DataFrame:
    """One row per series: keys, statistics, ``beta`` (in the order of
    :func:`forecast.feature_names`), ``break_at`` (years since the first
    training month) and ``slope_change`` of the breaks that were chosen,
    ``sigma_in``, ``var_0`` and ``var_1`` (variance by lead, model scale),
    ``n_fit``, ``train_end``. Rows without a target and the last ``holdout``
    rows of a series are left out of the fit; smaller ``prior``, fewer
    breaks. ``n_breaks`` or ``origins`` 0: a straight trend, no leads."""
    keys, drivers = list(keys), list(drivers)
    if prior <= 0 or step < 1 or not 0 < span <= 1:
        raise ValueError("prior above 0, step 1 at least, span in (0, 1]")
    w = Window.partitionBy(*keys).orderBy(F.col(ds).desc())
    train = df.filter(F.col(y).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > holdout).drop("_rn")
    stats, segments = segment_gram(train, keys, ds, y, drivers, n_season, n_breaks, span, origins, step, min_rows)
    p = 2 + 2 * n_season + len(drivers)
    sums = [f"g_{i}_{j}" for i in range(p) for j in range(i, p)] + [f"xy_{i}" for i in range(p)] + ["yy"]
    one = F.struct("bucket", F.array(*sums, F.col("n").cast("double")).alias("sums"))
    per = segments.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("segments"))  # at most n_breaks + origins + 1
    given = per.join(stats.select(*keys, "breaks", "origins", "_bounds", "_ymu", "_ysd"), keys)
    types = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    schema = (", ".join(f"{k} {types[k]}" for k in keys) + ", beta array<double>, break_at array<double>, "
              "slope_change array<double>, sigma_in double, var_0 double, var_1 double, n_fit long")
    return stats.drop("_m1", "breaks", "origins", "_bounds").join(given.mapInPandas(_solve(keys, p, ridge, prior, step), schema), keys)


def predict_piecewise(df: DataFrame, model: DataFrame, keys: Sequence[str], ds: str = "ds", drivers: Sequence[str] = (),
                      n_season: int = 3, y: str | None = "y", z: float = fc.Z80) -> DataFrame:
    """``yhat``, ``yhat_lower``, ``yhat_upper`` (and ``lead``, months past the
    training end, 0 inside it) of every row. Bounds inside the training
    months have the in-sample width, later ones that of their lead, and never
    less than a shorter lead's."""
    keys, drivers = list(keys), list(drivers)
    x = fc.design(df, model, keys, ds, drivers, n_season)
    t = F.col("x_trend").cast("double") / F.lit(fc.UNIT)
    bend = F.aggregate(F.arrays_zip("break_at", "slope_change"), F.lit(0.0),
                       lambda s, b: s + b["slope_change"] * F.greatest(t - b["break_at"], F.lit(0.0)))
    d, e = F.col(ds).cast("date"), F.col("train_end").cast("date")
    lead = F.greatest((F.year(d) - F.year(e)) * 12 + F.month(d) - F.month(e), F.lit(0))
    x = x.withColumns({"_eta": fc._eta(fc.feature_names(n_season, drivers)) + bend, "lead": lead})
    ahead = F.sqrt(F.col("var_0") + F.col("var_1") * F.col("lead"))
    sigma = F.when((F.col("lead") > 0) & ahead.isNotNull(), F.greatest("sigma_in", ahead)).otherwise(F.col("sigma_in"))
    x = x.withColumn("_s", F.lit(z) * sigma)
    mult = F.col("_multiplicative")

    def back(c: Column) -> Column:
        return F.when(mult, F.exp(c)).otherwise(c)

    x = x.withColumns({"yhat": back(F.col("_eta")), "yhat_lower": back(F.col("_eta") - F.col("_s")),
                       "yhat_upper": back(F.col("_eta") + F.col("_s"))})
    out = [*keys, ds, "lead"]
    if y and y in df.columns:
        x = x.withColumn("actual", F.col(y))
        out.append("actual")
    return x.select(*out, "yhat", "yhat_lower", "yhat_upper")
