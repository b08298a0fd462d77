"""Connected components of an edge table, as joins and grouped minima.

Alternating large-star and small-star steps: each step links the neighbours
of a node to the smallest of them, until only stars around the smallest node
of every component remain. The number of steps grows with the logarithm of
the size. A node with very many neighbours is reduced by partial minima
before the shuffle, and AQE may split its rows in the join. Each step is
written to the shared checkpoint folder, so a lost executor re-reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    rest = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(own).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge to another; the
    component is its smallest node. Loops and repeated edges are allowed."""
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = stored(_small_star(_large_star(e)), "stars")
        state, before = _state(e), state
        if state == before:
            break
    tops = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component")))
