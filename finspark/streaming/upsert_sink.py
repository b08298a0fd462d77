"""Micro-batch keyed upsert into a parquet table (R-10 over a stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import upsert_into_table

SEQ = "_load_seq"


def _merge_batch(path: str, keys: Sequence[str], order_cols: Sequence[str], partition_by: Sequence[str]):
    def run(batch: DataFrame, batch_id: int) -> None:
        # batch_id orders micro-batches: a later batch wins over an earlier one
        b = batch.withColumn(SEQ, F.lit(int(batch_id)).cast("bigint"))
        upsert_into_table(b, path, keys, [SEQ, *order_cols], partition_by)
    return run


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str,
                  order_cols: Sequence[str] = (), partition_by: Sequence[str] = (),
                  trigger: dict | None = None) -> StreamingQuery:
    """Start a query that upserts each micro-batch of ``stream`` into the
    parquet table at ``path`` (last writer wins on ``keys``; later batches
    win, then ``order_cols``). ``checkpoint`` must be a shared folder: the
    stream restarts from it after a driver or executor loss, and a batch
    that is retried rewrites the same result (the merge is idempotent).
    ``partition_by`` columns must be functions of ``keys`` (a key never moves
    between partitions), since only partitions touched by a batch are read
    and rewritten."""
    w = stream.writeStream.foreachBatch(_merge_batch(path, list(keys), list(order_cols), list(partition_by)))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
