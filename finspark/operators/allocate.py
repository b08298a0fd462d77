"""Budget allocation under a cap and per-department bounds (D-23).

The reference solves an LP with one ``sum(x) <= cap`` row and box bounds.
That LP is a continuous bounded knapsack, whose optimum is greedy by value:
every department gets its minimum, then the remaining cap goes to the
departments in decreasing value order up to their maximum. As Spark: a
running sum per scenario (distributed, see ``windows.running_sum_before``),
no solver and no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import sized_broadcast
from .windows import running_sum_before

# Value-score weights (ROI, operational efficiency, strategic importance).
WEIGHT_ROI = 0.5
WEIGHT_EFFICIENCY = 0.2
WEIGHT_STRATEGIC = 0.3
# Default upper bound multiple of the request when no maximum is given.
DEFAULT_MAX_MULTIPLE = 1.5
# The reference's two scenarios and caps.
REFERENCE_SCENARIOS = (("Baseline", 17000000.0), ("Tariff", 14800000.0))

AMOUNT = "decimal(38,6)"


def value_score(roi="roi_score", eff="efficiency_score", strat="strategic_score"):
    return (F.lit(WEIGHT_ROI) * F.col(roi) + F.lit(WEIGHT_EFFICIENCY) * F.col(eff)
            + F.lit(WEIGHT_STRATEGIC) * F.col(strat))


def allocate_budget(depts: DataFrame, scenarios: DataFrame, dept_col: str = "department",
                    requested: str = "requested_budget", min_col: str = "min_required",
                    max_col: str = "max_plausible", scenario_col: str = "scenario",
                    cap_col: str = "cap", keys: Sequence[str] = ()) -> DataFrame:
    """D-23: one row per (scenario, department) with the optimal allocation.

    Bounds: ``lo = min or 0``; ``hi = max or 1.5 x requested``; ``hi >= lo``.
    Value = 0.5 roi + 0.2 efficiency + 0.3 strategic. A scenario whose
    minimums exceed its cap is infeasible and emits no rows. Ties in value
    are broken by department name (any order is optimal). Amounts are exact
    decimals so the running sums do not depend on evaluation order.

    ``scenarios`` is ``(scenario, cap)`` (plus ``keys`` when caps differ per
    tenant): a handful of rows, equi-joined on ``keys`` or, without keys,
    attached to every department as a small array."""
    keys = list(keys)
    amt = lambda c: F.col(c).cast(AMOUNT)
    d = depts.select(
        *keys, F.col(dept_col).alias("department"), F.col(requested).alias("requested_budget"),
        F.col(min_col).alias("min_required"), F.col(max_col).alias("max_plausible"),
        value_score().alias("value_factor"),
        F.coalesce(amt(min_col), F.lit(0).cast(AMOUNT)).alias("_lo"),
        F.coalesce(amt(max_col), amt(requested) * F.lit(DEFAULT_MAX_MULTIPLE).cast("decimal(2,1)")).alias("_hi0"))
    d = d.withColumn("_hi", F.greatest("_hi0", "_lo")).drop("_hi0")
    sc = scenarios.select(*keys, F.col(scenario_col).alias("scenario"), amt(cap_col).alias("_cap"))
    if keys:
        x = d.join(sized_broadcast(sc), keys, "inner")
    else:
        # A scenario list is a few rows: attach it as one array (scalar
        # subquery) and explode, instead of a nested-loop join.
        arr = sc.agg(F.collect_list(F.struct("scenario", "_cap")).alias("a")).select("a").scalar()
        x = d.withColumn("_s", F.explode(arr)).select("*", "_s.scenario", "_s._cap").drop("_s")
    part = keys + ["scenario"]
    # Scenario totals as a grouped aggregate joined back, and the greedy
    # "budget taken by better departments" as a distributed running sum:
    # neither puts a whole scenario into one task.
    sum_lo = x.groupBy(*part).agg(F.sum("_lo").alias("_sum_lo"))
    x = x.withColumn("_room", (F.col("_hi") - F.col("_lo")).cast(AMOUNT))
    x = running_sum_before(x, part, [F.col("value_factor").desc(), F.col("department").asc()], "_room", "_before")
    x = x.join(sized_broadcast(sum_lo), part, "inner")
    room = F.col("_cap") - F.col("_sum_lo") - F.col("_before")
    extra = F.when(F.col("value_factor") > 0,
                   F.least(F.col("_hi") - F.col("_lo"), F.greatest(F.lit(0).cast(AMOUNT), room))) \
        .otherwise(F.lit(0).cast(AMOUNT))
    x = x.filter(F.col("_sum_lo") <= F.col("_cap"))
    return x.select(*keys, "scenario", "department",
                    *[F.col(c).cast("double").alias(c) for c in ("requested_budget", "min_required", "max_plausible")],
                    "value_factor", (F.col("_lo") + extra).cast("double").alias("optimized_allocation"))


def allocation_pivot(alloc: DataFrame, scenarios: Sequence[str], keys: Sequence[str] = (),
                     dept_col: str = "department") -> DataFrame:
    """R-48: department rows, one allocation column per listed scenario."""
    return (alloc.groupBy(*keys, dept_col).pivot("scenario", list(scenarios))
            .agg(F.first("optimized_allocation")))
