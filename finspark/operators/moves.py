"""Keyed upserts into a stored partitioned table whose keys may change
partition (R-10).

:func:`upsert.upsert_into_table` rewrites the partitions that the batch names.
A key that was stored in another one would then be there twice. Here the
places of the batch's keys are looked up first (a semi join that reads the
table's key columns alone), and old and new places are rewritten together, so
a key is in one place afterwards. Only those partitions are read whole and
written.

The change is prepared beside the table and takes effect by renames, one
partition at a time. What is prepared is complete before a marker is written,
and every step may be repeated, so a run that dies before the marker leaves
the table as it was, and one that dies after it is finished by the next call
(:func:`finish_pending`), whatever it was doing. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import optional_source
from .upsert import upsert

MARKER = "_ready.json"


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def _fs(spark: SparkSession, path: str):
    """(file system of ``path``, its Path type)."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def _same(left: DataFrame, right: DataFrame, cols: dict[str, str]):
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in cols.items()])


def _leaves(fs, kind, root: str) -> list[str]:
    """Partition folders below ``root`` that hold files, relative to it."""
    top, out, todo = kind(root), [], [kind(root)]
    base = fs.makeQualified(top).toUri().getPath().rstrip("/")
    while todo:
        found = fs.listStatus(todo.pop())
        if any(x.isFile() and not x.getPath().getName().startswith(("_", ".")) for x in found):
            out.append(found[0].getPath().getParent().toUri().getPath()[len(base):].strip("/"))
        todo += [x.getPath() for x in found if x.isDirectory()]
    return sorted(out)


def _replace(fs, kind, staged: str, live: str) -> None:
    """One partition takes the place of the stored one."""
    new, old = kind(staged), kind(live)
    if fs.exists(old):
        fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"cannot move {staged} to {live}; call finish_pending to go on")


def finish_pending(spark: SparkSession, path: str) -> bool:
    """Brings a prepared change of the table at ``path`` to its end, or drops
    one that was not prepared to the end; whether there was a complete one."""
    at = _pending(path)
    fs, kind = _fs(spark, path)
    if not fs.exists(kind(at)):
        return False
    ready = fs.exists(kind(f"{at}/{MARKER}"))
    if ready:
        stream = fs.open(kind(f"{at}/{MARKER}"))
        try:
            emptied = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        for leaf in _leaves(fs, kind, f"{at}/data"):  # those not yet moved
            _replace(fs, kind, f"{at}/data/{leaf}", f"{path.rstrip('/')}/{leaf}")
        for leaf in emptied:
            fs.delete(kind(f"{path.rstrip('/')}/{leaf}"), True)
    fs.delete(kind(at), True)
    return ready


def upsert_moving(batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], order_cols: Sequence[str] = (),
                  fmt: str = "parquet") -> None:
    """Upserts ``batch`` into the table stored at ``path``: its rows replace
    those of the same ``keys`` wherever they are, the last by ``order_cols``
    of one key wins, columns that the batch lacks keep their values, other
    rows stay. ``partition_by`` columns are in the batch and may change.
    Re-running a batch gives the same table."""
    spark = batch.sparkSession
    keys, parts = list(keys), list(partition_by)
    if not parts or set(parts) & set(keys):
        raise ValueError("partition_by: columns that are no keys; else upsert_into_table does")
    finish_pending(spark, path)
    at, live = _pending(path), path.rstrip("/")
    target = optional_source(spark, path, fmt)
    if target is None:
        upsert(None, batch, keys, order_cols).write.format(fmt).partitionBy(*parts).save(f"{at}/data")
        _commit(spark, path, [])
        return
    types = dict(target.dtypes)  # a partition's values read back in the types of its folders' names
    batch = batch.select(*[F.col(c).cast(types[c]).alias(c) if c in parts and c in types else F.col(c) for c in batch.columns])
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    placed = target.withColumn("_folder", folder)
    mine = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    old = placed.select(*keys, "_folder").join(mine, _same(placed, mine, {k: f"_k_{k}" for k in keys}), "left_semi").select("_folder")
    new = batch.select(*[F.col(c).alias(f"_p_{c}") for c in parts]).distinct()
    there = placed.select(*parts, "_folder").distinct()
    there = there.join(new, _same(there, new, {c: f"_p_{c}" for c in parts}), "left_semi").select("_folder")
    # One name (a URI) for each partition that is rewritten: a part of the table's folder listing.
    fs, kind = _fs(spark, path)
    as_uri = spark.sparkContext._jvm.java.net.URI
    touched = sorted(kind(as_uri(r[0])).toString() for r in old.distinct().union(there).distinct().collect())
    kept = (spark.read.format(fmt).option("basePath", live).schema(target.schema).load(touched) if touched else target.limit(0))
    upsert(kept, batch, keys, order_cols).write.format(fmt).partitionBy(*parts).save(f"{at}/data")
    base = fs.makeQualified(kind(live)).toUri().getPath().rstrip("/")
    leaves = [kind(f).toUri().getPath()[len(base):].strip("/") for f in touched]
    _commit(spark, path, sorted(set(leaves) - set(_leaves(fs, kind, f"{at}/data"))))


def _commit(spark: SparkSession, path: str, emptied: list[str]) -> None:
    """Writes the marker (whole, under another name first) and applies it."""
    at = _pending(path)
    fs, kind = _fs(spark, path)
    stream = fs.create(kind(f"{at}/{MARKER}.part"), True)
    try:
        stream.write(bytearray(json.dumps(emptied).encode()))
    finally:
        stream.close()
    if not fs.rename(kind(f"{at}/{MARKER}.part"), kind(f"{at}/{MARKER}")):
        raise OSError(f"cannot write {at}/{MARKER}")
    finish_pending(spark, path)
