"""Dimension ids kept in a stored table (R-13, D-01).

Ids outlive a load: each load adds the names it sees for the first time as
one batch folder with ids from the highest one on, and reads all committed
batches before. A batch counts from the moment its marker is there; what a
dead run left without one is not read and its number is used again. A load
that is repeated, or sees nothing new, adds nothing, so ids stay dense and
the same for good. Attributes are upserted by id beside. One writer at a
time; null names get no id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import optional_source
from .dimensions import distinct_names
from .upsert import dedupe, dense_index, upsert_into_table

MARKER = "_committed"


def _fs(spark: SparkSession, path: str):
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def _batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed batches, in their order."""
    fs, kind = _fs(spark, path)
    if not fs.exists(kind(path)):
        return []
    found = sorted(x.getPath().getName() for x in fs.listStatus(kind(path)) if x.isDirectory())
    return [f"{path.rstrip('/')}/{n}" for n in found if n.startswith("batch-") and fs.exists(kind(f"{path}/{n}/{MARKER}"))]


def stored_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """The names and ids so far, None without any."""
    own = _batches(spark, path)
    return spark.read.parquet(*own) if own else None


def register(names: DataFrame, path: str, name_col: str = "name", id_col: str = "id") -> DataFrame:
    """Gives the names that have no id yet the next ones, in name order;
    returns all names with their ids."""
    spark = names.sparkSession
    known = stored_ids(spark, path)
    new, first = names.select(name_col).filter(F.col(name_col).isNotNull()).distinct(), 1
    if known is not None:
        new = new.join(known.select(name_col), name_col, "left_anti")
        first = (known.agg(F.max(id_col)).first()[0] or 0) + 1
    fresh = dense_index(new, [name_col], id_col, first).select(name_col, id_col)
    if known is not None and fresh.isEmpty():
        return known
    at = f"{path.rstrip('/')}/batch-{len(_batches(spark, path)):08d}"
    fresh.write.mode("overwrite").parquet(at)
    fs, kind = _fs(spark, path)
    fs.create(kind(f"{at}/{MARKER}"), True).close()
    return stored_ids(spark, path)


def load_stored_dimension(sources: Sequence[DataFrame], path: str, attrs: DataFrame | None = None, attr_order: Sequence[str] = (),
                          name_col: str = "name", id_col: str = "id") -> DataFrame:
    """D-01 with ids and attributes in storage: the distinct names of
    ``sources`` and ``attrs`` registered, the attributes (last by
    ``attr_order`` of a name) upserted by id; returns the whole dimension."""
    spark = sources[0].sparkSession
    every = [*sources, *([attrs.select(name_col)] if attrs is not None else [])]
    ids = register(distinct_names(every, name_col), f"{path.rstrip('/')}/ids", name_col, id_col)
    kept = f"{path.rstrip('/')}/attributes"
    if attrs is not None:
        last = dedupe(attrs.filter(F.col(name_col).isNotNull()), [name_col], list(attr_order))
        upsert_into_table(last.join(ids, name_col).drop(name_col, *attr_order), kept, [id_col])
    stored = optional_source(spark, kept)
    return ids if stored is None else ids.join(stored, id_col, "left").select(name_col, id_col, *[c for c in stored.columns if c != id_col])
