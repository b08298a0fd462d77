"""Keyed writes without an ACID table format (R-10 .. R-13).

Winner selection is an aggregate (``max`` over a struct ordered by
precedence), not a ``row_number`` window: it combines map-side, so a key
holding a third of all rows is reduced before the shuffle instead of being
sorted in one task. Ordering on every column makes ties deterministic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEQ = "_batch_seq"


def _pick(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], last: bool) -> DataFrame:
    keys, order_cols = list(keys), list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    rank = F.struct(*[F.col(c).alias(c) for c in order_cols + rest])
    agg = F.max(rank) if last else F.min(rank)
    out = df.groupBy(*keys).agg(agg.alias("_w"))
    return out.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order_cols + rest])


def dedupe(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the greatest (``keep='last'``) or least row by
    ``order_cols`` then by every other column."""
    out = _pick(df, keys, order_cols, keep == "last")
    return out.select(*df.columns)


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           order_cols: Sequence[str] = ()) -> DataFrame:
    """R-10 ``ON CONFLICT DO UPDATE``: batch rows replace target rows with the
    same key; within one side the last row by ``order_cols`` wins. Columns
    the batch lacks keep the target's value."""
    keys, order_cols = list(keys), list(order_cols)
    if target is None:
        return dedupe(batch, keys, order_cols, "last")
    missing = [c for c in target.columns if c not in batch.columns]
    both = (target.withColumn(SEQ, F.lit(0))
            .unionByName(batch.withColumn(SEQ, F.lit(1)), allowMissingColumns=True))
    won = _pick(both.drop(*missing), keys, [SEQ] + order_cols, last=True)
    if missing:
        kept = both.filter(F.col(SEQ) == 0).groupBy(*keys).agg(
            F.max(F.struct(*[F.col(c) for c in order_cols + missing])).alias("_o"))
        won = won.join(kept.select(*keys, *[F.col(f"_o.{c}").alias(c) for c in missing]), keys, "left")
    return won.select(*target.columns, *[c for c in batch.columns if c not in target.columns])


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str],
               order_cols: Sequence[str] = ()) -> DataFrame:
    """R-11 ``ON CONFLICT DO NOTHING``: only keys absent from the target are
    added; among duplicates in the batch the first by ``order_cols`` wins."""
    new = dedupe(batch.join(target.select(*keys), list(keys), "left_anti"), keys, order_cols, "first")
    return target.unionByName(new.select(*target.columns))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """R-12: append-only, duplicates kept."""
    return target.unionByName(batch, allowMissingColumns=True)


def dense_index(df: DataFrame, order_cols: Sequence[str], out: str = "id", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Consecutive ids ``start..start+n-1`` in ``order_cols`` order, computed
    without moving the data into one task: range-partition into balanced
    chunks, position inside each chunk (a window per chunk), plus the row
    count of all earlier chunks (a table with one row per chunk, broadcast). ``order_cols`` must be
    unique so the numbering is deterministic. The range-partitioned rows are
    materialised once (dimension-sized: distinct names), since a second
    range shuffle could sample different bounds."""
    from ..session import materialize

    order_cols = list(order_cols)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id())
    # Range-chunk ids depend on the sampled bounds, so they are computed once
    # and stored: both branches below read the same values.
    s = materialize(s, "dense_index")
    # position inside a chunk (each chunk is one balanced range of the order)
    s = s.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)) - F.lit(1))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint"))
            .drop("_pid", "_pos", "_off"))


def assign_keys(names: DataFrame, name_col: str, existing: DataFrame | None = None,
                id_col: str = "id") -> DataFrame:
    """R-13 get-or-create surrogate keys: existing names keep their id, new
    distinct non-null names get ``max(id) + 1 ..`` in name order. Returns the
    full dimension ``(name_col, id_col)``."""
    new = names.select(name_col).filter(F.col(name_col).isNotNull()).distinct()
    if existing is None:
        return dense_index(new, [name_col], id_col, 1).select(name_col, id_col)
    new = new.join(existing.select(name_col), name_col, "left_anti")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).select("m").scalar()
    fresh = dense_index(new, [name_col], "_seq", 1).select(
        name_col, (F.col("_seq") + top).cast("bigint").alias(id_col))
    return existing.select(name_col, F.col(id_col).cast("bigint")).unionByName(fresh)


def upsert_into_table(batch: DataFrame, path: str, keys: Sequence[str], order_cols: Sequence[str] = (),
                      partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """R-10 against a stored table (the ``INSERT .. ON CONFLICT DO UPDATE``
    write path): read only the table partitions the batch touches, upsert,
    cut lineage with a reliable checkpoint (the result is computed from the
    files about to be replaced), then overwrite just those partitions
    (dynamic partition overwrite). Re-running the same batch gives the same
    table. ``partition_by`` columns must be functions of ``keys``."""
    from ..session import cut_lineage
    from ..sources.files import optional_source

    spark = batch.sparkSession
    # Only a missing path means "no table yet"; any other read error is raised
    # (treating it as empty would overwrite the table with the batch alone).
    target = optional_source(spark, path, fmt)
    if target is not None and partition_by:
        touched = batch.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by]).distinct()
        # Null-safe: rows of the null partition must be read back as well, as
        # the overwrite below replaces that partition like any other.
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_by])
        target = target.join(touched, same, "left_semi")
    merged = upsert(target, batch, keys, order_cols)
    if partition_by:
        merged = cut_lineage(merged)
        merged.write.mode("overwrite").format(fmt).partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic").save(path)
        return
    # Unpartitioned: write the whole result beside the table, then swap, so a
    # crash before the swap leaves the stored table as it was.
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    merged.write.format(fmt).save(staged)
    _swap(spark, staged, path)


def _swap(spark, staged: str, path: str) -> None:
    """Rename ``path`` aside, ``staged`` to ``path``, then drop the old one;
    if the second rename fails the first is undone."""
    jvm = spark.sparkContext._jvm
    new, live = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = live.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = fs.exists(live)
    if had and not fs.rename(live, old):
        raise OSError(f"cannot move {path} aside; the new table is in {staged}")
    if not fs.rename(new, live):
        if had:
            fs.rename(old, live)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(old, True)
