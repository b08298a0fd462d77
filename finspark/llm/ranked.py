"""Ranked lexical search by hybrid TAAT-DAAT retrieval (operator 12).

Every document is ranked for every item of a query table by integer scores of
its terms (runs of letters, digits and characters beyond ASCII, A-Z
lower-cased). The documents are the index's partitions: nothing but counts
and each partition's best documents moves between tasks.

1. One scan of the texts keeps, of each document, its length and its counts
   of the items' terms, stored under the shared checkpoint folder.
2. Document frequencies are partial counts summed by term; with the number
   of documents and of terms they fix weights and scores everywhere.
3. Each task builds posting lists of a bounded run of documents, with the
   largest score of each list, and answers every item from them. The item's
   shortest lists are taken term at a time: their scores are summed into
   accumulators, which become ONE list, ordered by document, with its own
   bound. That list and the long ones are then taken document at a time, in
   steps of ``STEP`` documents: only lists whose bounds can still lift a
   document to the ``k`` best give candidates; the others are only looked up
   at these, largest bound first, while the rest could still reach the k-th
   best score. Nothing is approximate.
4. The runs' best documents of an item are merged by rank; ranking takes the
   ``k`` best of each task before the shuffle.

The items go to every task. Their bytes are checked; beyond ``most_bytes``
they are taken in blocks, one scan of the documents each.

Defined results: null, empty and blank texts have no term and are in no
list; rows of one item are one item with the terms of all; repeated documents
are ranked each; a document without an id comes last among equals; an item
that no document scores above 0 for has no row, nor have empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import slices, stored

#: Postings of a run of documents; documents of a document-at-a-time step.
POSTINGS, STEP = 2 << 20, 4096
#: Item texts sent to every task at once.
MOST_BYTES = 16 << 20
#: Lower case of A-Z; bytes that are in no term become blanks.
TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())
COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The contract's score of a term in a document."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


# --- one run of documents --------------------------------------------------

class Postings:
    """Lists (documents in order, scores, bound) of a run of documents, which
    are in the order of their ids."""

    def __init__(self, lengths: list[int], terms: list[np.ndarray], counts: list[np.ndarray], weight: np.ndarray, documents: int,
                 total: int):
        m = np.array([10 + 90 * n * documents // total for n in lengths], np.int64)
        doc = np.repeat(np.arange(len(lengths)), [len(t) for t in terms])
        term = np.concatenate([*terms, np.zeros(0, np.int32)])
        order = np.argsort(term, kind="stable")
        term, self.doc = term[order], doc[order]
        tf = np.concatenate([*counts, np.zeros(0, np.int32)])[order].astype(np.int64)
        self.score = impacts(weight[term], tf, m[self.doc])
        self.first = np.searchsorted(term, np.arange(len(weight) + 1))
        self.bound = np.zeros(len(weight), np.int64)
        some = np.flatnonzero(np.diff(self.first))
        if len(some):
            self.bound[some] = np.maximum.reduceat(self.score, self.first[some])

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        return [(self.doc[a:b], self.score[a:b], int(self.bound[t]))
                for t, a, b in zip(terms.tolist(), self.first[terms].tolist(), self.first[terms + 1].tolist()) if self.bound[t] > 0]


def summed(lists: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Accumulators of some lists, term at a time, as one list."""
    doc = np.concatenate([d for d, _, _ in lists])
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    score = np.add.reduceat(np.concatenate([s for _, s, _ in lists])[order], at)
    return doc[at], score, int(score.max())


def best(lists: list[tuple[np.ndarray, np.ndarray, int]], k: int, short: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best documents over posting lists,
    best first, equal scores by document. Lists of up to ``short`` postings
    in all are summed beforehand."""
    none = np.zeros(0, np.int64)
    if not lists:
        return none, none
    lists = sorted(lists, key=lambda x: len(x[0]))
    n, size = 0, 0
    while n < len(lists) and (n == 0 or size + len(lists[n][0]) <= short):
        size += len(lists[n][0])
        n += 1
    lists = [summed(lists[:n]), *lists[n:]]
    floor = 1  # what the k-th best has at least
    if len(lists[0][1]) >= k:
        floor = max(floor, int(np.partition(lists[0][1], -k)[-k]))
    lists.sort(key=lambda x: x[2])
    reach = np.cumsum([0] + [b for _, _, b in lists]).tolist()  # of the lists before each
    top_doc, top = none, none
    lo, last = 0, max(int(d[-1]) for d, _, _ in lists)
    while lo <= last:
        asked = 0  # lists before it can't lift a document to the floor by themselves
        while asked < len(lists) and reach[asked + 1] < floor:
            asked += 1
        if asked == len(lists):
            break
        # Skip to the first document of a list that can.
        at = [int(np.searchsorted(d, lo)) for d, _, _ in lists[asked:]]
        heads = [int(d[a]) for (d, _, _), a in zip(lists[asked:], at) if a < len(d)]
        if not heads:
            break
        lo = min(heads)
        found = []
        for (d, s, b), a in zip(lists[asked:], at):
            e = int(np.searchsorted(d, lo + step))
            if e > a:
                found.append((d[a:e], s[a:e], b))
        doc, score, _ = summed(found) if len(found) > 1 else found[0]
        for i in range(asked - 1, -1, -1):
            may = score + reach[i + 1] >= floor
            doc, score = doc[may], score[may]
            if not len(doc):
                break
            d, s, _ = lists[i]
            p = np.minimum(np.searchsorted(d, doc), len(d) - 1)
            score = score + np.where(d[p] == doc, s[p], 0)
        may = score >= floor
        top_doc, top = np.concatenate((top_doc, doc[may])), np.concatenate((top, score[may]))
        order = np.lexsort((top_doc, -top))[:k]
        top_doc, top = top_doc[order], top[order]
        if len(top) == k:
            floor = max(floor, int(top[-1]))
        lo += step
    return top_doc, top


# --- the table -------------------------------------------------------------

def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats) and the counts of the vocabulary's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            for part in slices(batch):
                lengths, terms, counts = [], [], []
                for t in part.column("text").cast(pa.binary()).to_pylist():
                    words = terms_of(t) if t else []
                    ids = np.array([x for x in map(get, words) if x is not None], np.int32)
                    ids, tf = np.unique(ids, return_counts=True)
                    lengths.append(len(words))
                    terms.append(ids.tobytes())
                    counts.append(tf.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()),
                                                  pa.array(counts, pa.binary())], schema=COUNTS)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms binary, counts binary")


def frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for t in batch.column("terms").to_pylist():
                df[np.frombuffer(t, np.int32)] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    rows = counted.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(size, np.int64)
    df[rows["term"].to_numpy(np.int64)] = rows["df"].to_numpy(np.int64)
    return df


def search(docs: DataFrame, items: DataFrame, k: int = 10, short: int = 4096, most_bytes: int = MOST_BYTES, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", postings: int = POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each
    item with a score above 0."""
    if k < 1 or short < 1:
        raise ValueError("k, short: 1 at least")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    total = asked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // most_bytes))
    out = None
    for b in range(blocks):
        own = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found = _block(texts, own, k, short, postings)
        out = found if out is None else out.unionByName(found)
    w = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _block(texts: DataFrame, asked: DataFrame, k: int, short: int, most_postings: int) -> DataFrame:
    """The best documents of every run of documents for a block of items."""
    vocabulary: dict[bytes, int] = {}
    queries: dict = {}
    for r in asked.collect():  # at most MOST_BYTES of text and one item
        queries.setdefault(r["item_id"], set()).update(
            vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r["text"].encode("utf-8", "surrogatepass")))
    kind = asked.schema["item_id"].dataType
    schema = pa.schema([("item_id", to_arrow_type(kind)), ("doc_id", pa.int64()), ("score", pa.int64())])
    ddl = f"item_id {kind.simpleString()}, doc_id bigint, score bigint"
    counted = stored(count_terms(texts, vocabulary), "term-counts")
    sums = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    documents, total = sums["documents"], sums["terms"] or 0
    weight = weights(frequencies(counted, len(vocabulary)), documents)
    wanted = [(i, np.array(sorted(t), np.int64)) for i, t in queries.items() if t]

    def answers(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
        lists = Postings([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], weight, documents, total)
        out: list[tuple] = []
        for i, t in wanted:
            doc, score = best(lists.lists(t), k, short)
            out += [(i, rows[d][0], s) for d, s in zip(doc.tolist(), score.tolist())]
        cols = list(zip(*out)) if out else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for i, n, t, c in zip(*(batch.column(x).to_pylist() for x in COUNTS.names)):
                if t:
                    rows.append((i, n, np.frombuffer(t, np.int32), np.frombuffer(c, np.int32)))
                    size += len(t) // 4
                if size >= most_postings:
                    yield answers(rows)
                    rows, size = [], 0
        if rows:
            yield answers(rows)

    return counted.mapInArrow(run, ddl)
