"""Near-duplicate classes by fast similarity sketching (operator 10).

1. Sketch. A document's set is its distinct word shingles. Sketches of
   ``t = bands * rows`` coordinates are filled in rounds: in each round every
   element is thrown into a hashed bin with a hashed value, smaller rounds
   winning; after t rounds, t more rounds fill bin after bin, so every
   coordinate is filled for any set. Coordinates agree with probability equal
   to the Jaccard similarity, with concentration as for independent draws,
   in O(size + t log t) time.
2. Banding. Documents that agree on all rows of a band meet. Equal sets are
   one node (their smallest id). In each meeting the members are linked as
   candidates to one leader only, never all to all.
3. Verification on full sets, recomputed from the whole texts: links have
   100 * |intersection| >= share * |union|.
4. Components by star contraction.
5. Rest. Two documents that met have met one leader. Where a leader's
   partners still lie in different components, a link between them may be
   missing: there, partners of different components are compared inside tasks
   (in blocks, when there are many), by their sketches first, with a margin
   of many standard deviations, and then on their full sets. Only links that
   join components leave the task.

With 64 bands of 8 rows a pair at 0.8 is missed with probability 8e-6.

Hot spots: each slice of a task sends one entry for equal sets and bands;
what meets is packed by hash slices; a leader's candidates are verified in
lots of ``LOT`` with the leader's text sent to each lot.

Defined results: null, empty or blank text = empty set, linked with nothing;
one word = the set of it; an exact repetition of a row counts as its copy; a
row without an id is kept, without a component, and compared with nothing;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, id_text, mix, parts_for, slices, stored
from .components import components

BANDS, ROWS = 64, 8
#: Partners of a leader that are verified together; partners compared at once.
LOT, BLOCK = 256, 512
#: Sketches that agree on a share this far below the asked one aren't verified:
#: over 5 standard deviations of 512 coordinates at 0.8.
MARGIN = 0.1
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = WordHash()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; of the whole
    sequence when there are fewer words."""
    w = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    h = _WORDS.of(w)
    n = min(k, len(h))
    out = h[:len(h) - n + 1] + np.uint64(0x51ED270B * n)
    for j in range(1, n):
        out = mix(out) + h[j:len(h) - n + 1 + j]
    return np.unique(mix(out))


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of t filled coordinates for each (non-empty) set."""
    s = np.full((len(sets), t), np.iinfo(np.uint64).max, np.uint64)
    flat, none = s.ravel(), np.iinfo(np.uint64).max
    active = np.arange(len(sets))
    sizes = np.array([len(x) for x in sets], np.int64)
    owner, items = np.repeat(active, sizes), np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for r in range(2 * t):
        if not len(active):
            break
        x = mix(items + np.uint64((r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        value = np.uint64(r << 52) | (x >> np.uint64(12))
        place = owner * t + ((x & np.uint64(0xFFF)).astype(np.int64) % t if r < t else r - t)
        np.minimum.at(flat, place, value)
        todo = (s[active] == none).any(axis=1)
        if not todo.all():
            active = active[todo]
            left = np.zeros(len(sets), bool)
            left[active] = True
            keep = left[owner]
            owner, items = owner[keep], items[keep]
    return s


def band_keys(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key of each band of each sketch."""
    c = s.reshape(len(s), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), c.shape[:2])
    for j in range(rows):
        out = mix(out + c[:, :, j])
    return out


def sketch_table(docs: DataFrame, k: int, bands: int, rows: int, buckets: int) -> DataFrame:
    """Rows of two kinds: of documents (doc_id, n, fp) and of slices
    (_b and arrays of the band keys that fall into hash slice _b)."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("_b", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()), ("fps", pa.binary()),
                       ("ns", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                known = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy()
                sets = [shingles(x.as_py(), k) for x in part.column("text")]
                n = np.array([len(x) for x in sets], np.int64)
                fps = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                fp = np.array([np.frombuffer(f, "<u8")[0] for f in fps], np.uint64)
                full = np.flatnonzero((n > 0) & known)
                s = sketches([sets[i] for i in full], bands * rows)
                nothing = [None] * len(sets)
                cols = [part.column("doc_id"), n, fps, nothing, nothing, nothing, nothing, nothing]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, kinds)], schema=kinds)
                # Equal sets of the slice send one entry, of the smallest id.
                order = full[np.lexsort((ids[full], fp[full]))]
                one = order[np.concatenate(([True], fp[order][1:] != fp[order][:-1]))] if len(order) else order
                keys = band_keys(s, bands, rows)[np.searchsorted(full, one)]
                who = np.repeat(one, bands)
                keys = keys.ravel()
                b = ((keys >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
                order = np.argsort(b, kind="stable")
                which, at = np.unique(b[order], return_index=True)
                out = []
                for x, lo, hi in zip(which, at, [*at[1:], len(order)]):
                    o = order[lo:hi]
                    out.append((None, None, None, int(x), keys[o].tobytes(), ids[who[o]].astype("<i8").tobytes(),
                                fp[who[o]].tobytes(), n[who[o]].astype("<i8").tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, fp binary, _b int, keys binary, ids binary, fps binary, ns binary")


def meetings(table, share: int):
    """Of one hash slice: every (leader a, partner b) that met, and whether
    their sizes leave a link possible."""
    key, ids, fp, n = (np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()])
                       for c, t in (("keys", "<u8"), ("ids", "<i8"), ("fps", "<u8"), ("ns", "<i8")))
    order = np.lexsort((ids, fp, key))
    key, ids, fp, n = key[order], ids[order], fp[order], n[order]
    first = np.ones(len(key), bool)  # a node: equal key and set, the smallest id
    first[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    key, ids, fp, n = key[first], ids[first], fp[first], n[first]
    # The leader has the smallest hash of its id: the same one in most of its meetings.
    order = np.lexsort((mix(ids.view(np.uint64)), key))
    key, ids, fp, n = key[order], ids[order], fp[order], n[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lead = np.repeat(start, np.diff(np.concatenate((start, [len(key)]))))
    rest = np.flatnonzero(lead != np.arange(len(key)))
    lead = lead[rest]
    fits = 100 * np.minimum(n[rest], n[lead]) >= share * np.maximum(n[rest], n[lead])
    pairs = np.stack([ids[lead], fp[lead].view(np.int64), ids[rest], fp[rest].view(np.int64), fits.astype(np.int64)], axis=1)
    pairs = np.unique(pairs, axis=0)
    return pa.table([pairs[:, k] for k in range(5)], names=["a", "a_fp", "b", "b_fp", "fits"])


MEETINGS = "a bigint, a_fp bigint, b bigint, b_fp bigint, fits bigint"


def fp64(own: np.ndarray) -> int:
    """The set's short fingerprint, as meetings carry it."""
    return int.from_bytes(xxhash.xxh3_128_digest(own.tobytes())[:8], "little", signed=True)


def verified(docs: DataFrame, pairs: DataFrame, k: int, share: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the share. A leader a's
    partners come in lots; each lot is a run of sorted rows that begins with
    the leader, so a task holds one leader's set and one partner's."""
    n = parts_for(docs.sparkSession)
    lots = pairs.groupBy("a").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(LOT))).alias("lots"))
    pairs = pairs.join(lots, "a").withColumn("lot", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int"))
    need = pairs.select("a", "lot", F.lit(1).alias("part"), F.col("b").alias("doc_id"), F.col("b_fp").alias("fp")).unionByName(
        pairs.select("a", "lot", F.lit(0).alias("part"), F.col("a").alias("doc_id"), F.col("a_fp").alias("fp")).distinct())
    # A merge join at every size: the texts of candidates are a share of all.
    rows = need.join(docs.hint("merge"), "doc_id").repartition(n, "a", "lot").sortWithinPartitions("a", "lot", "part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lead = None, None
        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("a", "lot", "part", "doc_id", "fp", "text")]
            for a, lot, part, i, fp, text in zip(*cols):
                own = shingles(text, k)
                if fp64(own) != fp:
                    continue  # another row of the same id
                if part == 0:
                    at, lead = (a, lot), own
                elif at == (a, lot):
                    both = len(np.intersect1d(lead, own, assume_unique=True))
                    if 100 * both >= share * (len(lead) + len(own) - both):
                        out.append((a, i))
            cols = list(zip(*out)) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

    return rows.select("a", "lot", "part", "doc_id", "fp", "text").mapInArrow(run, "a bigint, b bigint").distinct()


def compare(table: pa.Table, k: int, share: int, bands: int, rows: int, cross: bool) -> list[tuple[int, int]]:
    """Links that join components, among the table's nodes (b, b_fp,
    component, _i, text); ``cross``: only between its two blocks."""
    ids, comp, block, fps = (table.column(c).to_numpy() for c in ("b", "component", "_i", "b_fp"))
    sets = [shingles(t.as_py(), k) for t in table.column("text")]
    right = np.array([fp64(x) == f for x, f in zip(sets, fps)], bool)  # not another row of the id
    n = np.array([len(x) for x in sets], np.int64)
    s = np.zeros((len(sets), bands * rows), np.uint64)
    if right.any():
        s[right] = sketches([x for x, r in zip(sets, right) if r], bands * rows)
    s = (s & np.uint64(0xFFFF)).astype(np.uint16)
    names, comp = np.unique(comp, return_inverse=True)
    top = np.argmax(np.bincount(comp))
    parent, links = np.arange(len(names)), []

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in np.flatnonzero(right & (comp != top)):  # the others meet all of another component
        ok = right & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= share * np.maximum(n, n[i]))
        if cross:
            ok &= block != block[i]
        j = np.flatnonzero(ok)
        like = (s[j] == s[i]).mean(axis=1)
        for x, e in sorted(zip(j.tolist(), like.tolist()), key=lambda r: -r[1]):
            if e < share / 100 - MARGIN:
                break
            p, q = find(comp[i]), find(comp[x])
            if p == q:
                continue
            both = len(np.intersect1d(sets[i], sets[x], assume_unique=True))
            if 100 * both >= share * (n[i] + n[x] - both):
                parent[q] = p
                links.append((int(ids[i]), int(ids[x])))
    return links


def rest_links(docs: DataFrame, met: DataFrame, labels: DataFrame, k: int, share: int, bands: int, rows: int) -> DataFrame:
    """The links (a, b) between partners of one leader that lie in different
    components so far."""
    c = met.select("a", "b", "b_fp").distinct().join(labels.withColumnRenamed("node", "b"), "b", "left").withColumn(
        "component", F.coalesce("component", "b"))
    open_ = c.groupBy("a").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                               F.count(F.lit(1)).alias("size")).filter("lo < hi").select("a", "size")
    nodes = c.join(open_, "a").withColumn("_n", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")).withColumn(
        "_i", F.pmod(F.xxhash64("b"), F.col("_n")).cast("int"))
    # Blocks of many partners are compared two by two.
    nodes = nodes.join(docs.withColumnRenamed("doc_id", "b").hint("merge"), "b")
    nodes = nodes.withColumn("_j", F.explode(F.expr("sequence(0, _n - 1)"))).select(
        "a", F.least("_i", "_j").alias("_x"), F.greatest("_i", "_j").alias("_y"), "_i", "b", "b_fp", "component", "text")

    def run(key, table):
        links = compare(table, k, share, bands, rows, key[1].as_py() != key[2].as_py())
        cols = list(zip(*links)) if links else ((), ())
        return pa.table([pa.array(x, pa.int64()) for x in cols], names=["a", "b"])

    return nodes.groupBy("a", "_x", "_y").applyInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, k: int = 2, share: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    texts = id_text(docs, id_col, text_col)
    buckets = min(max(parts_for(docs.sparkSession), texts.count() * bands // 500_000), 1 << 24)
    both = stored(sketch_table(texts, k, bands, rows, buckets), "sketches")
    own = both.filter("_b is null")

    def meet(table):
        return meetings(table, share)

    met = stored(both.filter("_b is not null").select("_b", "keys", "ids", "fps", "ns").groupBy("_b").applyInArrow(
        meet, MEETINGS).distinct(), "meetings")
    links = stored(verified(texts, met.filter("fits = 1"), k, share), "links")
    labels = components(links)
    more = stored(rest_links(texts, met, labels, k, share, bands, rows), "rest")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = own.filter("n > 0 and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = classes.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    out = own.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("fp")).alias("fp")).join(classes, "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
                      ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
