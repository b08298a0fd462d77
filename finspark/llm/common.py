"""Helpers shared by the corpus operators: narrow reads, bounded slices of
Arrow batches, stable hashes and the tables kept between jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: Text handled at once inside a task; lists built from it stay bounded.
SLICE_BYTES = 4 << 20
#: Text of a group of documents that is worked on together.
GROUP_BYTES = 8 << 20
#: Odd multipliers of a splitmix finaliser (fixed values).
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null text kept), under fixed names, so extra
    columns of any name neither reach Python nor clash with results."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold_of(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def slices(batch: pa.RecordBatch, text_col: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about ``most`` bytes of text (one
    row at least)."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    sizes = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """Word (bytes) -> 64-bit hash; forgets everything at ``most`` words, so
    a long-lived worker's memory stays bounded."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``k`` values, mixed; built by doubling, so it
    costs O(log k) vector passes. Position i covers h[i : i + k]."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    m = (1 << 64) - 1
    out, done, power = None, 0, 1  # out covers the first `done` values from each start
    cur, width, mul = mix(h + np.uint64(0x2545F4914F6CDD1D)), 1, base
    rest = k
    while rest:
        if rest & 1:
            if out is None:
                out = cur
            else:
                n = min(len(out), len(cur) - done)
                out = out[:n] + np.uint64(power) * cur[done:done + n]
            done += width
            power = power * mul & m
        rest >>= 1
        if rest:
            cur = cur[:-width] + np.uint64(mul) * cur[width:]
            mul, width = mul * mul & m, width * 2
    return mix(out[:len(h) - k + 1])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared checkpoint folder, read back."""
    return materialize(df, f"llm-{name}")


def parts_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(mask: np.ndarray) -> np.ndarray:
    """(start, end) of each maximal run of True, as an (n, 2) array."""
    d = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.stack([np.flatnonzero(d == 1), np.flatnonzero(d == -1)], axis=1)


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Boolean mask of the n places covered by [s, s + width) for s in starts."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:-1]) > 0


def grouped(docs: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """The documents with their group ``_g``, dealt out by it; groups hold
    about ``group_bytes`` of text however large the table is."""
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = parts_for(docs.sparkSession)
    groups = max(2 * n, -(-total // group_bytes))
    g = F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int")
    return docs.withColumn("_g", g).repartition(max(n, min(groups, 1 << 20) // 2), "_g"), groups


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Slices of the hash space present in a sorted array: (bucket, first place)."""
    b = ((sorted_hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    return np.unique(b.astype(np.int64), return_index=True)


def low_bytes(h: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def from_low(b: bytes, n: int) -> np.ndarray:
    raw = np.zeros((len(b) // n, 8), np.uint8)
    raw[:, :n] = np.frombuffer(b, np.uint8).reshape(-1, n)
    return raw.view("<u8").ravel()


def table_of(names: list[str], rows: list[tuple], kinds: list[pa.DataType]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
