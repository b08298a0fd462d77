"""Join helpers: a broadcast hint only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sides estimated below this are broadcast; anything larger (or unknown) is
# left to the planner (sort-merge / shuffle-hash, AQE may still convert).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate for ``df`` (no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # Spark Connect or a plan without statistics
        return None


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is known and under ``limit``;
    otherwise ``df`` unchanged so Spark plans a shuffle join."""
    n = estimated_bytes(df)
    if n is not None and n <= limit:
        return F.broadcast(df)
    return df


def outer_merge(frames, keys):
    """R-33 N-way full outer join on the same keys as ``unionByName`` + one
    ``groupBy``: one shuffle for N inputs instead of N-1 join shuffles. Inputs
    must not repeat a key; of a repeated one the least value of each column
    is taken, whatever the rows' order."""
    keys = list(keys)
    u = None
    for f in frames:
        u = f if u is None else u.unionByName(f, allowMissingColumns=True)
    vals = [c for c in u.columns if c not in keys]
    return u.groupBy(*keys).agg(*[F.min(c).alias(c) for c in vals])


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row aggregate to all rows of ``df`` through a
    single scalar subquery (one evaluation), instead of a cross join or one
    subquery per column."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.withColumn("_scalars", s).withColumns({c: F.col(f"_scalars.{c}") for c in cols}).drop("_scalars")
