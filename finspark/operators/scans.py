"""Carries along an order without putting a whole group into one task
(R-54 .. R-57 on one long series, or with a hot entity).

A fill or a step to the neighbouring row is an associative carry: what a run
of rows hands on to the next one is a single row - its last non-null value,
or its last row at all. So the rows are range-partitioned by (keys, order)
into balanced chunks, each chunk is finished by itself, and of every (keys,
chunk) only the rows at its edges travel: they come from partial aggregates,
and a window over these (chunks times keys, no data rows) gives what enters
each chunk from the ones before or behind it. A single series of a billion
rows is thus spread over all tasks, like many short ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import sized_broadcast


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], forward: Mapping[str, str] | None = None,
          backward: Mapping[str, str] | None = None, previous: Mapping[str, str] | None = None,
          following: Mapping[str, str] | None = None, num_chunks: int | None = None) -> DataFrame:
    """``df`` with, per ``keys`` in ``order``, for each {new column: source}

    * ``forward``: the last non-null value up to the row (R-56),
    * ``backward``: the next non-null value from the row on (R-57),
    * ``previous``: the row before's value, null kept (R-54, R-55),
    * ``following``: the row behind's value, null kept.

    ``keys`` may be empty (one series); null keys are one group, nulls in
    ``order`` come first. ``order`` has to tell rows of a group apart where
    their values differ. A new column may replace its source."""
    keys, order = list(keys), list(order)
    asked = {"f": dict(forward or {}), "b": dict(backward or {}), "p": dict(previous or {}), "n": dict(following or {})}
    new = [c for m in asked.values() for c in m]
    if not new or len(set(new)) != len(new):
        raise ValueError("name each new column once, and one at least")
    if set(new) & {*keys, *order}:
        raise ValueError("keys and order columns can't be replaced")
    spark = df.sparkSession
    n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Chunks depend on sampled bounds: stored once, so that all below agree.
    spread = materialize(df.repartitionByRange(n, *keys, *order).withColumn("_chunk", F.spark_partition_id()), "scan")
    o = F.struct(*order)

    # What each chunk of a group hands on.
    edge = {}
    for kind, last in (("f", True), ("b", False), ("p", True), ("n", False)):
        for out, src in asked[kind].items():
            row = F.struct(o.alias("o"), F.col(src).alias("v"))
            if kind in "fb":
                row = F.when(F.col(src).isNotNull(), row)
            edge[f"_{kind}_{out}"] = F.max(row) if last else F.min(row)
    edges = spread.groupBy(*keys, "_chunk").agg(*[v.alias(k) for k, v in edge.items()])
    ahead = Window.partitionBy(*keys).orderBy("_chunk")
    behind = Window.partitionBy(*keys).orderBy(F.col("_chunk").desc())
    enter = []
    for name in edge:
        w = (ahead if name[1] in "fp" else behind).rowsBetween(Window.unboundedPreceding, -1)
        enter.append(F.last(name, ignorenulls=True).over(w).getField("v").alias(name))
    names = {k: f"_k_{k}" for k in keys}
    # Stored, so that the join below knows its true size.
    given = materialize(edges.select(*[F.col(k).alias(v) for k, v in names.items()], F.col("_chunk").alias("_k_chunk"), *enter),
                        "scan-edges")

    local_up = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).asc() for c in order])
    local_down = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).desc() for c in order])
    grow = (Window.unboundedPreceding, Window.currentRow)
    own: dict[str, Column] = {}
    for out, src in asked["f"].items():
        own[f"_o_{out}"] = F.last(src, ignorenulls=True).over(local_up.rowsBetween(*grow))
    for out, src in asked["b"].items():
        own[f"_o_{out}"] = F.last(src, ignorenulls=True).over(local_down.rowsBetween(*grow))
    # A struct tells a null value of the neighbour from having none.
    for out, src in asked["p"].items():
        own[f"_o_{out}"] = F.lag(F.struct(F.col(src).alias("v"))).over(local_up)
    for out, src in asked["n"].items():
        own[f"_o_{out}"] = F.lag(F.struct(F.col(src).alias("v"))).over(local_down)
    rows = spread.withColumns(own)
    same = reduce(and_, [rows[k].eqNullSafe(given[v]) for k, v in names.items()], rows["_chunk"] == given["_k_chunk"])
    joined = rows.join(sized_broadcast(given), same, "left")
    done = {}
    for kind, m in asked.items():
        for out in m:
            mine, entered = F.col(f"_o_{out}"), F.col(f"_{kind}_{out}")
            done[out] = F.coalesce(mine, entered) if kind in "fb" else F.when(mine.isNotNull(), mine.getField("v")).otherwise(entered)
    cols = [*df.columns, *[c for c in new if c not in df.columns]]
    return joined.select(*[done[c].alias(c) if c in done else F.col(c) for c in cols])
