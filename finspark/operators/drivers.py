"""Driver scenarios: shocks, window overlay and history splicing (D-11 .. D-13).

Scenarios are a column, not a process argument: one job shocks the
indicator table for every scenario at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach_scalars, sized_broadcast

# The reference tariff scenario (driver, relative shock) and window.
TARIFF_SHOCKS = (("ev_component_cost_index", 0.25), ("consumer_confidence_index", -0.15))
TARIFF_WINDOW = ("2025-03-01", "2026-06-30")


def shock_table(spark, scenario: str, shocks, start: str, end: str) -> DataFrame:
    """Build a ``(scenario, driver, pct, start, end)`` table from a list."""
    rows = [(scenario, d, float(p), start, end) for d, p in shocks]
    return spark.createDataFrame(rows, "scenario string, driver string, pct double, start string, end string") \
        .select("scenario", "driver", "pct", F.col("start").cast("date").alias("start"),
                F.col("end").cast("date").alias("end"))


def shock_drivers(ind: DataFrame, shocks: DataFrame, ds: str = "ds",
                  drivers: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """D-11: one copy of ``ind`` per scenario of ``shocks`` with each named
    driver multiplied by ``(1 + pct)`` where ``start <= ds <= end``
    (inclusive). Shocks naming a driver the table lacks are skipped;
    several shocks on one driver and date multiply.

    ``shocks`` is a scenario definition (a few rows): it is attached to every
    indicator row as one small array (scalar subquery) and applied with
    higher-order functions, so no join or Python runs per row."""
    keys = list(keys)
    drivers = list(drivers or [c for c in ind.columns if c not in keys and c != ds])
    arr = shocks.agg(F.collect_list(F.struct(
        "scenario", "driver", F.col("pct").cast("double").alias("pct"),
        F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))).alias("a")
    ).select("a").scalar()
    names = shocks.agg(F.array_sort(F.collect_set("scenario")).alias("s")).select("s").scalar()
    x = ind.withColumn("scenario", F.explode(names)).withColumn("_sh", arr)
    d = F.col(ds).cast("date")

    def factor(name: str) -> Column:
        hits = F.filter("_sh", lambda s: (s["scenario"] == F.col("scenario")) & (s["driver"] == F.lit(name))
                        & (d >= s["start"]) & (d <= s["end"]))
        return F.aggregate(hits, F.lit(1.0), lambda acc, s: acc * (F.lit(1.0) + s["pct"]))

    x = x.withColumns({c: F.col(c) * factor(c) for c in drivers})
    return x.select("scenario", *keys, ds, *drivers)


def overlay_window(base: DataFrame, alt: DataFrame, start, end, ds: str = "ds",
                   cols: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """D-12: inside ``[start, end]`` take the alternative value (null when the
    alternative lacks that period), outside keep the base value. Rows are
    those of ``base`` (left join on keys + period)."""
    keys = list(keys)
    cols = list(cols or [c for c in base.columns if c not in keys and c != ds])
    a = alt.select(*keys, ds, *[F.col(c).alias(f"{c}__alt") for c in cols])
    j = base.join(a, keys + [ds], "left")
    inside = (F.col(ds) >= F.lit(start).cast("date")) & (F.col(ds) <= F.lit(end).cast("date"))
    return j.select(*keys, ds, *[F.when(inside, F.col(f"{c}__alt")).otherwise(F.col(c)).alias(c) for c in cols])


def splice_history(older: DataFrame, newer: DataFrame, keys: Sequence[str] = (), ds: str = "ds",
                   source_col: str | None = "source") -> DataFrame:
    """D-13 / R-67: per entity, rows of ``older`` strictly before the first
    period of ``newer``, then all of ``newer``. Both sides are snapped to
    month end first (G2: a month-start synthetic row would otherwise repeat
    the first actual month). The per-entity first period is a grouped
    aggregate joined back (broadcast when small)."""
    keys = list(keys)
    o = older.withColumn(ds, F.last_day(F.col(ds).cast("date")))
    n = newer.withColumn(ds, F.last_day(F.col(ds).cast("date")))
    first = n.groupBy(*keys).agg(F.min(ds).alias("_first"))
    o = o.join(sized_broadcast(first), keys, "left") if keys else attach_scalars(o, first)
    o = o.filter(F.col("_first").isNull() | (F.col(ds) < F.col("_first"))).drop("_first")
    if source_col:
        o = o.withColumn(source_col, F.lit("synthetic"))
        n = n.withColumn(source_col, F.lit("actual"))
    return o.unionByName(n, allowMissingColumns=True)


def training_frame(targets: DataFrame, drivers: DataFrame, keys: Sequence[str] = (), ds: str = "ds",
                   driver_cols: Sequence[str] | None = None) -> DataFrame:
    """D-13 (second half): targets joined with drivers on the period (and
    ``keys`` the driver table shares); rows lacking any driver are dropped,
    which makes the reference's outer join + ``dropna`` an inner join."""
    dk = [k for k in keys if k in drivers.columns]
    driver_cols = list(driver_cols or [c for c in drivers.columns if c not in dk and c != ds])
    j = targets.join(drivers.select(*dk, ds, *driver_cols), dk + [ds], "inner")
    return j.na.drop(subset=driver_cols)
