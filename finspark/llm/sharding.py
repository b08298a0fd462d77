"""Proportional stratified interleaving into shards (operator 6).

Rows are shuffled by a seeded hash inside their source and ranked there; the
fractional rank (rank + 1/2) / (rows of the source) spreads every source
evenly over [0, 1). Sorting all rows by it interleaves the sources in
proportion, and cutting the order into equal runs gives shards whose counts
differ by one row at most and whose mixture is that of the whole.

Both orders are global and distributed: range-partitioned, sorted inside the
partitions and numbered by partition offsets (one small row per partition).
No window and no group holds a source, so a source with a third of all rows
costs nothing special. Only ids, source and digests move, never texts.

:func:`write_shards` writes the rows themselves, shard by shard in slot order.

Defined results: a null source is a source of its own; null or empty texts
are rows like others; repeated rows each get a slot (ties broken by every
digest column); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, stored


def numbered(df: DataFrame, order: list[Column], out: str, name: str) -> DataFrame:
    """Consecutive numbers from 0 in ``order``: the range-partitioned, sorted
    rows are stored once (their place is part of the row), then each
    partition's offset, one small row per partition, is added."""
    n = parts_for(df.sparkSession)
    at = F.monotonically_increasing_id()
    s = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", at)
    s = stored(s.withColumn("_pid", F.shiftright("_at", 33).cast("int"))
               .withColumn("_pos", F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at"), name)
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort: as bounded as the partition count.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return s.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")


def interleave(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every row, and its
    number ``row_col``, if it has one."""
    own = [F.col(row_col).alias("_row")] if row_col else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text).cast("bigint") + F.lit(16)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *own)
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "source"))
    ties = [F.col("_h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    # Rank inside the source = place in (source, hash) order less the source's first place.
    placed = numbered(rows, [F.col("source").asc_nulls_first(), *ties], "_g", "by-source")
    per = placed.groupBy("source").agg(F.min("_g").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    ranked = placed.alias("p").join(per.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))).select(
        "p.*", ((F.col("_g") - F.col("_first") + F.lit(0.5)) / F.col("_rows")).alias("_frac"))
    order = [F.col("_frac"), F.col("source").asc_nulls_first(), *ties]
    spread = numbered(ranked.drop("_g"), order, "_k", "by-fraction")
    # Shard i takes places ceil(i n / shards) .. ceil((i + 1) n / shards) - 1.
    total = spread.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    exact = F.expr(f"(_k * {int(shards)}) div _n")
    return (spread.withColumn("_n", total).withColumn("shard", exact.cast("int"))
            .withColumn("slot", F.col("_k") - F.expr(f"(shard * _n + {int(shards) - 1}) div {int(shards)}"))
            .select("doc_id", "source", "size", "text_crc32", "shard", "slot", *(["_row"] if row_col else [])))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", files: int | None = None) -> None:
    """Writes all rows with all their columns as Parquet under ``path``, one
    folder ``shard=i`` for each shard, with a column ``slot``. Inside a shard
    the rows lie in slot order, over files in the order of their names, so a
    shard may be larger than a task; ``files`` is the number of tasks. Places
    are those of :func:`interleave`; each row is numbered and stored first,
    so repeated rows get a slot each and a repeated task reads the same rows.
    Columns of ``docs`` named ``shard`` or ``slot`` are an error."""
    taken = {"shard", "slot"} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"columns in the way: {sorted(taken)}")
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    placed = interleave(rows, shards, seed, id_col, text_col, source_col, row).select(F.col("_row").alias(row), "shard", F.col("slot").cast("bigint").alias("slot"))
    whole = rows.join(placed, row).drop(row)
    n = files or max(shards, parts_for(docs.sparkSession))
    (whole.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
