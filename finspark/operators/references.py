"""Names to ids where one name may hold a third of the rows (R-34, R-35).

A join on the name would send all rows of a hot name to one task. The names
are counted first (an aggregate that combines map-side); a name with more
than one ``slots``-th of the rows is hot, so fewer than ``slots`` names are,
however large the table: their ids are broadcast and their rows never move.
The other rows are joined by name, at most a ``slots``-th of them per name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def name_counts(df: DataFrame, name_col: str) -> DataFrame:
    """Rows of every name that is not null, stored (one row per name)."""
    return materialize(df.filter(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("_name")).agg(
        F.count(F.lit(1)).alias("_n")), "name_counts")


def resolve_names(df: DataFrame, dim: DataFrame, name_col: str, out: str, name_key: str = "name", id_col: str = "id",
                  keep_unmatched: bool = False, slots: int | None = None) -> DataFrame:
    """``df`` with the id of its name as ``out`` (as :func:`dimensions.lookup`,
    for a dimension too large to broadcast). Names of ``dim`` are unique.
    Rows whose name is null or has no entry are dropped, or kept with a null
    id (``keep_unmatched``). Reads ``df`` three times, one of them the name
    alone; a costly ``df`` is stored by the caller first."""
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = dim.select(F.col(name_key).alias("_name"), F.col(id_col).alias(out))
    counts = name_counts(df, name_col)
    total = counts.agg(F.sum("_n").alias("n")).select("n").scalar()
    # Fewer than `slots` names can have more than a `slots`-th of all rows.
    hot = F.broadcast(counts.filter(F.col("_n") * F.lit(slots) > total).select("_name").join(ids, "_name", "left"))
    name = F.col(name_col) == F.col("_name")
    of_hot = df.join(hot, name, "inner").drop("_name")
    rest = df.filter(F.col(name_col).isNotNull()).join(hot.select("_name"), name, "left_anti")
    rest = rest.join(ids, name, "left" if keep_unmatched else "inner").drop("_name")
    if not keep_unmatched:
        return of_hot.filter(F.col(out).isNotNull()).unionByName(rest)
    unnamed = df.filter(F.col(name_col).isNull()).withColumn(out, F.lit(None).cast(ids.schema[out].dataType))
    return of_hot.unionByName(rest).unionByName(unnamed)
