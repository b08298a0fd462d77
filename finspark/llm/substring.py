"""Substring dedup over words by fixed-block anchors (operator 1).

A window is ``window`` consecutive words of one document; every word covered
by a window whose word sequence also starts earlier (smaller document id, or
earlier in the same document) is removed.

1. Anchors. Documents are cut into non-overlapping blocks of ``window / 2``
   words, the reference blocks; any window holds a whole one. The index of
   block hashes is probed with EVERY rolling run of that many words. A hit
   is a run that equals a block and occurs more than once.
2. Extension. A hit can grow to a repeat of ``window`` words only inside the
   windows around it; these windows are matched on their full sequence (96
   bits of hash) and the first occurrence of each is found. Consecutive
   repeated windows join to maximal exact repeats.
3. Removal, on the words of the whole document.

Nothing is done pair by pair. Documents are dealt to groups of about
``GROUP_BYTES`` of text by a hash of the id; each group sends every distinct
hash once (so a passage in a third of all documents costs one entry a group,
not one a copy) to the task that owns a slice of the hash space, packed in
arrays, and gets back bits or hashes. The texts move once: the three steps
share one exchange.

Defined results: null or empty text = no words, empty kept text; documents
with fewer words than a window keep all; ties of id (repeated rows) are
ordered by text, so an exact repetition of a row counts as later; rows
without an id come after all others, in the order of their texts, and are
dealt to groups like others (they take the highest ids while the job runs);
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (GROUP_BYTES, WordHash, bucket_edges, covered, from_low, grouped, id_text, low_bytes, rolling, runs,
                     stored, table_of)
from .sharding import numbered

OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                 ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
OUT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
#: The last of the rows without an id, which come after all others.
NO_ID = (1 << 63) - 1
_WORDS = WordHash()


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than the six ASCII blanks."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def with_ids(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows without an id numbered by text up to ``NO_ID``, so that they don't
    make up one group; and the first number given. Only they are sorted."""
    unnamed = stored(docs.filter("doc_id is null").select("text"), "unnamed")
    n = unnamed.count()
    if not n:
        return docs, NO_ID
    named = numbered(unnamed, [F.col("text").asc_nulls_first()], "_k", "unnamed-order")
    named = named.select((F.col("_k") + F.lit(NO_ID - n + 1)).cast("bigint").alias("doc_id"), "text")
    return docs.filter("doc_id is not null").unionByName(named), NO_ID - n + 1


class Group:
    """The words of a group's documents, in (id, text) order, as one array of
    hashes; ``rows`` are the row numbers, shorter documents left out."""

    def __init__(self, table: pa.Table, least: int):
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])
        self.table = table.take(order)
        self.ids = self.table.column("doc_id").to_numpy()
        hashes, self.rows = [], []
        for r, t in enumerate(self.table.column("text")):
            w = words_of(t.as_py())
            if len(w) >= least:
                hashes.append(_WORDS.of(w))
                self.rows.append(r)
        self.n = np.array([len(h) for h in hashes], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))[:-1] if hashes else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first, self.n)  # in its document
        self.left = np.repeat(self.n, self.n) - self.place  # words from here to the document's end

    def windows(self, k: int, base: int = 0x9E3779B97F4A7C15) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of all runs of k words inside documents."""
        starts = np.flatnonzero(self.left >= k)
        return starts, rolling(self.hashes, k, base)[starts] if len(starts) else np.zeros(0, np.uint64)


def anchors(g: Group, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``block`` words (sorted), which of them is a reference
    block, which occurs twice in the group; starts and each start's number."""
    starts, h = g.windows(block)
    u, back, count = np.unique(h, return_inverse=True, return_counts=True)
    is_block = np.zeros(len(u), bool)
    is_block[back[g.place[starts] % block == 0]] = True
    return u, is_block, count > 1, starts, back


def short_ids(ids: np.ndarray) -> tuple[int, bytes]:
    """The least id, and the distances to it in four bytes each where they fit."""
    least = int(ids.min())
    wide = int(ids.max()) - least >= 1 << 32
    return least, ids.astype("<i8").tobytes() if wide else (ids - least).astype("<u4").tobytes()


def long_ids(least: int, packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<i8") if len(packed) == 8 * n else np.frombuffer(packed, "<u4").astype(np.int64) + least


def substring_dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text",
                    group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word numbers of each removed run)
    and kept (the words left, joined by one blank) of every document."""
    if window < 2:
        raise ValueError("window: two words at least")
    block = window // 2  # 2 * block - 1 <= window: any window holds a whole block
    named, unnamed_from = with_ids(id_text(docs, id_col, text_col))
    d, groups = grouped(named, group_bytes)
    buckets = min(groups, 1 << 24)
    i32, blob = pa.int32(), pa.binary()

    def send_anchors(key, table):
        u, is_block, twice, _, _ = anchors(Group(table, window), block)
        b, at = bucket_edges(u, buckets)
        rows = [(int(k), key[0].as_py(), low_bytes(u[x:y], 5), np.packbits(is_block[x:y]).tobytes(),
                 np.packbits(twice[x:y]).tobytes()) for k, x, y in zip(b, at, [*at[1:], len(u)])]
        return table_of(["_b", "_g", "hashes", "is_block", "twice"], rows, [i32, i32, blob, blob, blob])

    def probe(table):
        hs = [from_low(x.as_py(), 5) for x in table.column("hashes")]
        n = [len(h) for h in hs]
        flag = {c: np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=k).view(bool)
                                   for x, k in zip(table.column(c), n)]) for c in ("is_block", "twice")}
        _, back, count = np.unique(np.concatenate(hs), return_inverse=True, return_counts=True)
        block_any, often = np.zeros(len(count), bool), count > 1
        block_any[back[flag["is_block"]]] = True
        often[back[flag["twice"]]] = True
        hit = np.split((block_any & often)[back], np.cumsum(n)[:-1])
        rows = [(g.as_py(), b.as_py(), np.packbits(h).tobytes())
                for g, b, h in zip(table.column("_g"), table.column("_b"), hit) if h.any()]
        return table_of(["_g", "_b", "hits"], rows, [i32, i32, blob])

    def extend(key, table, replies):
        names, kinds = ["_b", "_g", "hashes", "more", "least", "ids"], [i32, i32, blob, blob, pa.int64(), blob]
        if not table.num_rows or not replies.num_rows:
            return table_of(names, [], kinds)
        g = Group(table, window)
        u, _, _, starts, back = anchors(g, block)
        hit = np.zeros(len(u), bool)
        b, at = bucket_edges(u, buckets)
        ends = dict(zip(b.tolist(), zip(at, [*at[1:], len(u)])))
        for k, bits in zip(replies.column("_b").to_pylist(), replies.column("hits").to_pylist()):
            x, y = ends[k]
            hit[x:y] = np.unpackbits(np.frombuffer(bits, np.uint8), count=y - x).view(bool)
        # A window is tried if a hit starts at any of its first window - block + 1 words.
        near = np.zeros(len(g.hashes) + 1, np.int64)
        near[1:][starts[hit[back]]] = 1
        near = np.cumsum(near)
        at20, h = g.windows(window)
        tried = near[at20 + window - block + 1] > near[at20]
        at20, h = at20[tried], h[tried]
        u, one = np.unique(h, return_index=True)  # the first occurrence in the group
        more = rolling(g.hashes, window, 0xD6E8FEB86659FD93)[at20[one]] if len(u) else u
        ids = g.ids[g.rows][np.searchsorted(g.first, at20[one], side="right") - 1] if len(u) else np.zeros(0, np.int64)
        b, at = bucket_edges(u, buckets)
        rows = [(int(k), key[0].as_py(), low_bytes(u[x:y], 8), low_bytes(more[x:y], 4),
                 *short_ids(ids[x:y])) for k, x, y in zip(b, at, [*at[1:], len(u)])]
        return table_of(names, rows, kinds)

    def first_of(table):
        hs = [np.frombuffer(x.as_py(), "<u8") for x in table.column("hashes")]
        n = [len(h) for h in hs]
        h, more = np.concatenate(hs), np.concatenate([from_low(x.as_py(), 4) for x in table.column("more")])
        ids = np.concatenate([long_ids(a, x, k) for a, x, k in zip(table.column("least").to_pylist(),
                                                                   table.column("ids").to_pylist(), n)])
        order = np.lexsort((ids, more, h))
        later = np.zeros(len(h), bool)
        later[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (more[order[1:]] == more[order[:-1]])
        rows = [(g.as_py(), x[m].tobytes()) for g, x, m in zip(table.column("_g"), hs, np.split(later, np.cumsum(n)[:-1]))
                if m.any()]
        return table_of(["_g", "hashes"], rows, [i32, blob])

    def remove(key, table, replies):
        g = Group(table, window)
        starts, h = g.windows(window)
        again = np.zeros(len(h), bool)
        if len(h):
            _, one, back = np.unique(h, return_index=True, return_inverse=True)
            again = one[back] != np.arange(len(h))  # not the first in the group
            if replies.num_rows:
                known = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in replies.column("hashes").to_pylist()]))
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                again |= known[at] == h
        gone = covered(len(g.hashes), starts[again], window) if len(h) else again
        inside = dict(zip(g.rows, zip(g.first, g.first + g.n)))
        cols: list[list] = [[] for _ in OUT]
        for r, (i, t) in enumerate(zip(g.ids, g.table.column("text"))):
            words, spans = words_of(t.as_py()), []
            n = len(words)
            if r in inside and (m := gone[slice(*inside[r])]).any():
                spans = [{"start": int(a), "end": int(b)} for a, b in runs(m)]
                words = [w for w, x in zip(words, m.tolist()) if not x]
            for c, v in zip(cols, (None if i >= unnamed_from else int(i), n, n - len(words), spans, b" ".join(words).decode("utf-8", "surrogatepass"))):
                c.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, OUT)], schema=OUT)

    def by_key(df: DataFrame, fn, ddl: str, key: str) -> DataFrame:
        return df.groupBy(key).applyInArrow(fn, ddl)

    sent = by_key(d, send_anchors, "_b int, _g int, hashes binary, is_block binary, twice binary", "_g")
    hits = by_key(sent, probe, "_g int, _b int, hits binary", "_b")
    tried = d.groupBy("_g").cogroup(hits.groupBy("_g")).applyInArrow(
        extend, "_b int, _g int, hashes binary, more binary, least bigint, ids binary")
    repeats = by_key(tried, first_of, "_g int, hashes binary", "_b")
    return d.groupBy("_g").cogroup(repeats.groupBy("_g")).applyInArrow(remove, OUT_DDL)
