"""Removal of repeated byte strings with per-shard suffix arrays (operator 7).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else (another document or place) is removed; matches stay inside documents.

1. Routing. In each window of ``length`` bytes the smallest hashed k-gram is
   its anchor, so equal windows have equal anchors, wherever they are. A span
   is a maximal run of windows with one anchor. Spans meet by anchor in the
   hash slice that owns it, as two hashes each; equal spans are collapsed to
   one with a count, so a passage in a third of all documents is one span an
   anchor. A span whose anchor is alone can't hold a repeat and stays home;
   one that occurs twice is a repeat as a whole.
2. Suffix arrays. The texts of different spans with one anchor go to a shard,
   where Larsson-Sadakane refinement (numpy: sort by seven symbols, then
   double the depth for unsorted groups only) orders the suffixes and Kasai's
   algorithm, run for all spans in step, gives common prefixes. A window that
   shares ``length`` bytes with a neighbour in the order is a repeat.
3. Cross-shard merging. An anchor with more spans than fit a shard is spread
   over several. Their different windows, as sorted fingerprints cut into
   ranges, are merged range by range by binary search of each in the others.
4. Removal from the whole documents, joined by id with their spans.

Work grows with the text (1, 4) and the text around repeats' ends (2, 3),
never with pairs; a shard holds ``SHARD_BYTES`` at once.

Defined results: null text = empty; rows without an id are neither cut nor
searched; texts shorter than ``length`` keep all;
exact repetitions of a row repeat each other; an empty table gives an empty
result. What is kept are bytes: a cut may split a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GROUP_BYTES, bucket_edges, grouped, id_text, mix, rolling, stored, table_of

K = 32
#: Windows handled at once; text whose suffixes are sorted at once.
CHUNK, SHARD_BYTES = 1 << 20, 1 << 20
SEP, END = 256, 511  # symbols between texts and beyond the last
ALONE, WHOLE, TEXT, WITNESS = 0, 1, 2, 3  # what a group is told about a span
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept", pa.binary())])
OUT_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
FOUND = [("doc_id", pa.int64()), ("ver", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]


# --- spans -----------------------------------------------------------------

def chunks(table: pa.Table, length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """(doc_id, version, offset, bytes) in lots of about CHUNK windows; long
    texts are cut by window starts, with the bytes that the windows need."""
    lot, size = [], 0
    for i, t in zip(table.column("doc_id").to_pylist(), table.column("text")):
        raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
        ver = xxhash.xxh64_intdigest(raw) - (1 << 63)
        for a in range(0, len(raw) - length + 1, CHUNK):
            lot.append((i, ver, a, raw[a:a + CHUNK + length - 1]))
            size += len(lot[-1][3])
            if size >= CHUNK:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def spans_of(lot: list[tuple[int, int, int, bytes]], length: int):
    """Of the lot's text: (raw bytes, part of each span, first and last
    window start, anchor hash, span hash), window starts in the joined text."""
    raw = b"".join(x[3] for x in lot)
    sizes = np.array([len(x[3]) for x in lot])
    first = np.concatenate(([0], np.cumsum(sizes)))
    h = rolling(np.frombuffer(raw, np.uint8).astype(np.uint64), K)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, want = 1, length - K + 1  # smallest key of `want` k-grams, leftmost of equals
    while 2 * width <= want:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < want:
        key = np.minimum(key[:len(key) - (want - width)], key[want - width:])
    part = np.repeat(np.arange(len(lot)), sizes - length + 1)
    starts = np.arange(len(part)) + part * (length - 1)  # places in the joined text
    at = (key[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (part[1:] != part[:-1])))
    lo = np.flatnonzero(new)
    hi = np.concatenate((lo[1:], [len(at)])) - 1
    # Smallest hashes crowd at the low end: mixed again, they spread over the slices.
    p1, p2, anchor = starts[lo], starts[hi], mix(h[at[lo]])
    view = memoryview(raw)
    delta = (at[lo] - p1).tolist()
    span = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b + length], d) for a, b, d in zip(p1.tolist(), p2.tolist(), delta)),
                       np.uint64, len(lo))
    return raw, first, part[lo], p1, p2, anchor, span


def merged(rows: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(doc_id, version, start, end) with overlapping ones joined."""
    out: list[list[int]] = []
    for r in sorted(rows):
        if out and out[-1][:2] == list(r[:2]) and r[2] <= out[-1][3]:
            out[-1][3] = max(out[-1][3], r[3])
        else:
            out.append(list(r))
    return [tuple(x) for x in out]


# --- suffix arrays ---------------------------------------------------------

def suffix_array(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and the packed first seven symbols of each. The
    order is complete (Kasai's bound needs it); only groups that are still
    equal at a depth are sorted again, so few rounds go beyond a span."""
    n = len(sym)
    padded = np.concatenate((sym, np.full(8, END, sym.dtype))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | padded[j:n + j]
    sa = np.argsort(key)
    heads = np.concatenate(([True], key[sa[1:]] != key[sa[:-1]]))
    rank = np.full(n + 1, n + 1, np.int64)  # 1 + place of the group's head; the end is the largest
    rank[sa] = np.maximum.accumulate(np.where(heads, np.arange(1, n + 1), 0))
    h = 7
    while True:
        open_ = ~(heads & np.concatenate((heads[1:], [True])))  # in a group of two or more
        where = np.flatnonzero(open_)
        if not len(where):
            return sa, key
        sub = sa[where]
        k = (rank[sub] << 32) | rank[np.minimum(sub + h, n)]
        o = np.argsort(k)
        sub, k = sub[o], k[o]
        sa[where] = sub
        heads[where] = np.concatenate(([True], k[1:] != k[:-1]))
        place = np.maximum.accumulate(np.where(heads, np.arange(1, n + 1), 0))
        rank[sub] = place[where]
        h *= 2


def kasai(sym: np.ndarray, sa: np.ndarray, key: np.ndarray, first: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
    """Common prefix (up to ``most``) of each of the ``count`` suffixes from
    each ``first`` with its predecessor in the order. Kasai's walk goes along
    all runs at once: one step right loses one symbol of the prefix at most."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    pad = most + 16
    key = np.concatenate((key, np.zeros(pad, np.uint64)))
    sym = np.concatenate((sym, np.full(pad, SEP, sym.dtype)))
    lcp = np.zeros(n, np.int64)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    run = np.zeros(len(first), np.int64)
    for step in range(int(count[0]) if len(count) else 0):
        live = int(np.searchsorted(-count, -step, side="left"))  # runs with count > step
        i = first[:live] + step
        j = before[i]
        ln = np.maximum(run[:live] - 1, 0)
        go = np.flatnonzero(j >= 0)
        ln[j < 0] = 0
        while len(go):  # seven symbols at a time
            go = go[(key[i[go] + ln[go]] == key[j[go] + ln[go]]) & (ln[go] < most)]
            ln[go] += 7
        go = np.flatnonzero((j >= 0) & (ln < most))
        while len(go):
            a = sym[i[go] + ln[go]]
            go = go[(a == sym[j[go] + ln[go]]) & (a != SEP) & (ln[go] < most)]
            ln[go] += 1
        run[:live] = ln
        lcp[i] = ln
    return lcp


def repeated_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over the windows of all texts (each ``length`` bytes or longer): starts
    in the joined array, which text, and whether the window occurs twice."""
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    sym = np.full(int(sizes.sum()) + len(texts), SEP, np.uint16)
    for a, t in zip(first, texts):
        sym[a:a + len(t)] = np.frombuffer(t, np.uint8)
    sa, key = suffix_array(sym)
    count = sizes - length + 1
    lcp = kasai(sym, sa, key, first, count, length)
    place = np.empty(len(sa), np.int64)
    place[sa] = np.arange(len(sa))
    text = np.repeat(np.arange(len(texts)), count)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[text]
    after = place[starts] + 1
    nxt = np.where(after < len(sa), sa[np.minimum(after, len(sa) - 1)], -1)
    twice = (lcp[starts] >= length) | ((nxt >= 0) & (lcp[nxt] >= length))
    return starts - first[text], text, twice


# --- the operator ----------------------------------------------------------

def repeats(docs: DataFrame, length: int, group_bytes: int = GROUP_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, ver, start, end): bytes covered by repeated windows; ``ver``
    is the text's hash. ``docs`` has doc_id and text."""
    d, groups = grouped(docs.filter("doc_id is not null"), group_bytes)
    buckets = min(groups, 1 << 24)
    i32, i64, blob = pa.int32(), pa.int64(), pa.binary()

    def send(key, table):
        a, s = [], []
        for lot in chunks(table, length):
            *_, anchor, span = spans_of(lot, length)
            a.append(anchor)
            s.append(span)
        if not a:
            return table_of(["_b", "_g", "anchors", "spans", "twice"], [], [i32, i32, blob, blob, blob])
        a, s = np.concatenate(a), np.concatenate(s)
        order = np.lexsort((s, a))
        a, s = a[order], s[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])))
        at = np.flatnonzero(new)
        twice = np.diff(np.concatenate((at, [len(a)]))) > 1
        a, s = a[at], s[at]
        b, at = bucket_edges(a, buckets)
        rows = [(int(k), key[0].as_py(), a[x:y].tobytes(), s[x:y].tobytes(), np.packbits(twice[x:y]).tobytes())
                for k, x, y in zip(b, at, [*at[1:], len(a)])]
        return table_of(["_b", "_g", "anchors", "spans", "twice"], rows, [i32, i32, blob, blob, blob])

    def tell(table):
        a = [np.frombuffer(x, "<u8") for x in table.column("anchors").to_pylist()]
        n = [len(x) for x in a]
        a, s = np.concatenate(a), np.concatenate([np.frombuffer(x, "<u8") for x in table.column("spans").to_pylist()])
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=k).view(bool)
                                for x, k in zip(table.column("twice").to_pylist(), n)])
        group = np.repeat(table.column("_g").to_numpy(), n)
        order = np.lexsort((group, s, a))
        a, s, twice, group = a[order], s[order], twice[order], group[order]
        new_a = np.concatenate(([True], a[1:] != a[:-1]))
        new = new_a | np.concatenate(([True], s[1:] != s[:-1]))
        number = np.cumsum(new) - 1  # of the different spans
        entries = np.bincount(number)
        often = (entries > 1) | np.isin(np.arange(len(entries)), number[twice])
        of = np.cumsum(new_a) - 1
        kinds = np.bincount(of[new])[of]  # different spans of the anchor
        says = np.where(kinds == 1, np.where(often[number], WHOLE, ALONE),
                        np.where(often[number], np.where(new, WITNESS, WHOLE), TEXT)).astype(np.uint8)
        # An anchor with more text than a shard takes is spread over several.
        shards = np.maximum(1, -(-kinds * (length + K) // shard_bytes))
        shard = (mix(s) % shards.astype(np.uint64)).astype(np.int64) | ((shards > 1).astype(np.int64) << 30)
        keep = says != ALONE
        a, s, says, group, shard = a[keep], s[keep], says[keep], group[keep], shard[keep].astype(np.int32)
        order = np.argsort(group, kind="stable")
        g, at = np.unique(group[order], return_index=True)
        rows = []
        for k, x, y in zip(g, at, [*at[1:], len(order)]):
            o = order[x:y]
            rows.append((int(k), a[o].tobytes(), s[o].tobytes(), says[o].tobytes(), shard[o].tobytes()))
        return table_of(["_g", "anchors", "spans", "says", "shards"], rows, [i32, blob, blob, blob, blob])

    names = ["_b", "_s", "doc_id", "ver", "start", "end", "anchor", "text"]
    kinds = [i32, i32, i64, i64, i64, i64, i64, blob]

    def give(key, table, replies):
        if not table.num_rows or not replies.num_rows:
            return table_of(names, [], kinds)
        a, s, says, shard = (np.concatenate([np.frombuffer(x, t) for x in replies.column(c).to_pylist()])
                             for c, t in (("anchors", "<u8"), ("spans", "<u8"), ("says", np.uint8), ("shards", "<i4")))
        known = mix(a) + s
        order = np.argsort(known)
        known, says, shard = known[order], says[order], shard[order]
        whole, rows, shown = [], [], set()
        for lot in chunks(table, length):
            raw, first, part, p1, p2, anchor, span = spans_of(lot, length)
            own = mix(anchor) + span
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            told = np.where(known[at] == own, says[at], ALONE)
            bucket = ((anchor >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
            for x in np.flatnonzero(told != ALONE).tolist():
                i, ver, off, _ = lot[part[x]]
                lo, hi = int(p1[x]), int(p2[x]) + length
                off -= int(first[part[x]])
                if told[x] != TEXT:
                    whole.append((i, ver, lo + off, hi + off))
                if told[x] == TEXT or told[x] == WITNESS and own[x] not in shown:
                    rows.append((int(bucket[x]), int(shard[at[x]]), i, ver, lo + off, 1 if told[x] == TEXT else 0,
                                 int(anchor[x].view(np.int64)), raw[lo:hi]))
                    if told[x] == WITNESS:
                        shown.add(own[x])
        rows += [(-1, 0, *r, 0, None) for r in merged(whole)]
        return table_of(names, rows, kinds)

    def sort_shard(key, table):
        """Repeated windows of a shard; of a spread anchor, its windows too."""
        spread = key[1].as_py() >= 1 << 30
        table = table.sort_by([("anchor", "ascending"), ("text", "ascending"), ("doc_id", "ascending")])
        cols = [table.column(c).to_pylist() for c in ("doc_id", "ver", "start", "end", "anchor", "text")]
        size = np.cumsum([0] + [len(t) + 1 for t in cols[5]])
        anchor = np.array(cols[4])
        ends = np.flatnonzero(np.concatenate((anchor[1:] != anchor[:-1], [True]))) + 1  # whole anchors together
        out, lo = [], 0
        while lo < len(anchor):
            fits = ends[(ends > lo) & (size[ends] - size[lo] <= shard_bytes)]
            hi = int(fits[-1]) if len(fits) else int(ends[ends > lo][0])
            out += _shard([c[lo:hi] for c in cols], length, spread, key[0].as_py())
            lo = hi
        return table_of(["kind", "_b", "_r", *(n for n, _ in FOUND), "prints", "refs"], out,
                        [i32, i32, i32, *(k for _, k in FOUND), blob, blob])

    def cross(table):
        """Windows of spread anchors in one fingerprint range, as sorted runs
        of the shards: each run is searched in the others by binary search."""
        lists = [np.frombuffer(x, "<u8") for x in table.column("prints").to_pylist()]
        refs = [np.frombuffer(x, "<i8").reshape(-1, 3) for x in table.column("refs").to_pylist()]
        every = np.sort(np.concatenate(lists))  # the merged run; a shard sends a window once
        found = []
        for own, ref in zip(lists, refs):
            elsewhere = np.searchsorted(every, own, side="right") - np.searchsorted(every, own, side="left") > 1
            for i, ver, p in ref[elsewhere & (ref[:, 2] >= 0)].tolist():
                found.append((i, ver, p, p + length))
        return table_of([n for n, _ in FOUND], merged(found), [k for _, k in FOUND])

    sent = d.groupBy("_g").applyInArrow(send, "_b int, _g int, anchors binary, spans binary, twice binary")
    told = sent.groupBy("_b").applyInArrow(tell, "_g int, anchors binary, spans binary, says binary, shards binary")
    given = stored(d.groupBy("_g").cogroup(told.groupBy("_g")).applyInArrow(
        give, "_b int, _s int, doc_id bigint, ver bigint, start bigint, end bigint, anchor bigint, text binary"), "spans")
    shards = stored(given.filter("_b >= 0").groupBy("_b", "_s").applyInArrow(
        sort_shard, "kind int, _b int, _r int, doc_id bigint, ver bigint, start bigint, end bigint, prints binary, "
                    "refs binary"), "shards")
    found = "doc_id bigint, ver bigint, start bigint, end bigint"
    across = shards.filter("kind = 1").select("_b", "_r", "prints", "refs").groupBy("_b", "_r").applyInArrow(cross, found)
    cols = ["doc_id", "ver", "start", "end"]
    return given.filter("_b < 0").select(*cols).unionByName(shards.filter("kind = 0").select(*cols)).unionByName(across)


def _shard(cols: list[list], length: int, spread: bool, bucket: int) -> list[tuple]:
    """Rows (kind, bucket, range, doc_id, ver, start, end, prints, refs): the
    repeated places, and of spread anchors the different windows."""
    ids, vers, offs, asked, anchors, texts = cols
    starts, text, twice = repeated_windows(texts, length)
    hit = np.flatnonzero(twice & np.array(asked, bool)[text])
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(starts[hit]) != 1) | (np.diff(text[hit]) != 0)))) if len(hit) else hit
    places = [(ids[t], vers[t], offs[t] + a, offs[t] + b + length)
              for t, a, b in zip(text[hit[cut]].tolist(), starts[hit[cut]].tolist(),
                                 starts[hit[np.concatenate((cut[1:], [len(hit)])) - 1]].tolist())] if len(hit) else []
    out = [(0, bucket, 0, *r, None, None) for r in merged(places)]
    if not spread:
        return out
    h = np.concatenate([rolling(np.frombuffer(t, np.uint8).astype(np.uint64), length) for t in texts])
    h = mix(h + np.array(anchors, np.int64).view(np.uint64)[text])
    h, one = np.unique(h, return_index=True)
    need = ~twice[one] & np.array(asked, bool)[text[one]]  # others are settled, and only searched for
    refs = np.stack([np.array(ids)[text[one]], np.array(vers)[text[one]],
                     np.where(need, np.array(offs)[text[one]] + starts[one], -1)], axis=1).astype("<i8")
    r = (h >> np.uint64(58)).astype(np.int64)  # 64 ranges
    which, at = np.unique(r, return_index=True)
    return out + [(1, bucket, int(k), None, None, None, None, h[x:y].tobytes(), refs[x:y].tobytes())
                  for k, x, y in zip(which, at, [*at[1:], len(h)])]


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = GROUP_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept
    (the bytes left) of every document."""
    if length < 2 * K:
        raise ValueError(f"length: {2 * K} bytes at least")
    texts = id_text(docs, id_col, text_col)
    per = spans_by_document(texts, length, group_bytes, shard_bytes)
    return texts.join(per, "doc_id", "left").mapInArrow(_remove, OUT_DDL)


def spans_by_document(texts: DataFrame, length: int, group_bytes: int = GROUP_BYTES,
                      shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id and _spans (version, start, end); a document has few after merging."""
    spans = repeats(texts, length, group_bytes, shard_bytes)
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("ver", "start", "end")).alias("_spans"))


def without_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the repeated bytes taken out of the text; a
    character that a cut splits goes. Null texts stay null."""
    own = {"doc_id": "_id", "_spans": "_spans"}  # names that the documents don't have
    for k in own:
        while own[k] in docs.columns:
            own[k] += "_"
    per = spans_by_document(id_text(docs, id_col, text_col), length).withColumnsRenamed(own)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else t if s is None else _kept(t.encode("utf-8", "surrogatepass"), s)[0].decode(
            "utf-8", "ignore") for t, s in zip(texts, spans)], dtype=object)

    joined = docs.join(per, F.col(id_col).cast("bigint") == F.col(own["doc_id"]), "left")
    return joined.withColumn(text_col, cut(F.col(text_col).cast("string"), own["_spans"])).select(*docs.columns)


def _kept(raw: bytes, spans) -> tuple[bytes, int]:
    """What is left of a text, and how many runs went."""
    ver = xxhash.xxh64_intdigest(raw) - (1 << 63)
    own = merged([(0, 0, x["start"], x["end"]) for x in spans if x["ver"] == ver])
    kept, at = [], 0
    for _, _, a, b in own:
        kept.append(raw[at:a])
        at = b
    return b"".join((*kept, raw[at:])), len(own)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in OUT]
        for i, t, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "_spans"))):
            raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
            kept, n = _kept(raw, spans.as_py()) if spans.is_valid else (raw, 0)
            for c, v in zip(cols, (i.as_py(), len(raw), len(raw) - len(kept), n, kept)):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, OUT)], schema=OUT)
