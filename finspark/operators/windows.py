"""Running sums that do not put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import sized_broadcast


def running_sum_before(df: DataFrame, part: Sequence[str], order: Sequence[Column], value: str, out: str,
                       num_chunks: int | None = None) -> DataFrame:
    """``out = sum(value)`` over the rows of the same ``part`` that come
    strictly before each row in ``order`` (a total order): the window
    ``sum() over (partition by part order by .. rows unbounded preceding ..
    1 preceding)`` computed without collecting a group in one task.

    Rows are range-partitioned on ``(part, order)`` into balanced chunks, each
    chunk computes its local running sum, and each chunk's offset is the total
    of the earlier chunks of the same group (a table of at most
    ``num_chunks x groups`` rows, broadcast). Null ``value`` counts as 0."""
    part = list(part)
    n = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(n, *[F.col(p) for p in part], *order).withColumn("_chunk", F.spark_partition_id())
    v = F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))
    local = F.sum(v).over(Window.partitionBy(*part, "_chunk").orderBy(*order)
                          .rowsBetween(Window.unboundedPreceding, -1))
    # Chunk ids depend on the sampled range bounds: store the chunked rows
    # once so the totals and the rows agree (one write of the input's size).
    r = materialize(r.withColumn("_local", local), "running_sum")
    tot = r.groupBy(*part, "_chunk").agg(F.sum(v).alias("_tot"))
    off = tot.select(*part, "_chunk", F.sum("_tot").over(
        Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    zero = F.lit(0).cast(df.schema[value].dataType)
    return (r.join(sized_broadcast(off), part + ["_chunk"], "left")
            .withColumn(out, F.coalesce("_off", zero) + F.coalesce("_local", zero))
            .drop("_chunk", "_local", "_off"))
