"""Toxicity by multiple-instance learning (operator 5).

Labels mark documents, yet a document is toxic because of some sentences. A
sentence's probability is a logistic function of its words; the document's is
their noisy-or, 1 - prod(1 - p). Weights are fitted to document labels
through the noisy-or, so the same model then points at the sentences.

Features of a sentence are its distinct words and their first three to five
characters (inflected or joined forms of one stem share these), hashed.

Fitting uses a bounded sample: at most ``max_train_docs`` labelled documents
of at most ``max_train_chars`` characters, the first by a hash of the id, so
the sample does not depend on the layout. Everything else - scores - covers
every document's whole text in one scan without a shuffle.

Defined results: null and empty texts have no sentence and score 0; a label
that is null is ignored; several labels of one document count as the largest;
without usable labels of both kinds every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

#: Hashed features; letters (and bytes of other characters) kept, ends of
#: sentences become line ends, everything else a blank.
SPACE = 1 << 22
TABLE = bytes(10 if c in b".!?\n" else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def sentences(text: str) -> list[list[bytes]]:
    """Distinct words of each sentence that has any."""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(TABLE)
    return [list(set(w)) for s in raw.split(b"\n") if (w := s.split())]


def features(word: bytes) -> list[int]:
    """The word's own feature and those of its beginnings."""
    w = word.decode("utf-8", "replace")
    own = [xxhash.xxh32_intdigest(b"=" + word) % SPACE]
    return own + [xxhash.xxh32_intdigest(w[:k].encode() + b"^") % SPACE for k in (3, 4, 5) if len(w) > k]


class Lookup(dict):
    """Word -> something made once; forgets everything at ``most`` words."""

    def __init__(self, make, most: int = 200_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        v = self[word] = self.make(word)
        return v


@dataclass
class Model:
    ids: np.ndarray  # features with a weight, sorted
    weights: np.ndarray
    bias: float

    def lookup(self) -> Lookup:
        own = dict(zip(self.ids.tolist(), self.weights.tolist()))
        return Lookup(lambda w: sum(own.get(f, 0.0) for f in features(w)))

    def sentence_scores(self, text: str | None, lookup: Lookup) -> np.ndarray:
        z = [sum(map(lookup.__getitem__, s)) for s in sentences(text or "")]
        return 1 / (1 + np.exp(-np.clip(np.array(z, float) + self.bias, -35, 35)))

    def score(self, text: str | None, lookup: Lookup) -> float:
        p = self.sentence_scores(text, lookup)
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def fit_noisy_or(feats: np.ndarray, sent: np.ndarray, doc: np.ndarray, y: np.ndarray, dims: int, steps: int = 120,
                 rate: float = 0.15, l1: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the documents' log loss under the
    noisy-or, by Adam with soft thresholding. ``sent`` is the sentence of each
    feature occurrence, ``doc`` the document of each sentence."""
    n_sent, n_doc = len(doc), len(y)
    w, b = np.zeros(dims), -np.log(10 * max(1.0, n_sent / n_doc))
    m, v, mb, vb = np.zeros(dims), np.zeros(dims), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(sent, w[feats], n_sent) + b
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), n_doc)  # log prod(1 - p)
        tox = np.maximum(-np.expm1(clean), 1e-9)
        dz = p * np.where(y, -np.exp(clean) / tox, 1.0)[doc] / n_doc
        g, gb = np.bincount(feats, dz[sent], dims), dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        w -= step * m / (1 - 0.9 ** t)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-6)
    return w, float(b)


def training_rows(docs: DataFrame, labels: DataFrame, label: Column, usable: Column, max_train_docs: int,
                  max_train_chars: int, id_col: str, text_col: str) -> pd.DataFrame:
    """The sample's feature arrays, one row per document."""
    own = labels.filter(usable).select(F.col(id_col).cast("bigint").alias("doc_id"), label.cast("int").alias("y"))
    own = own.filter("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    # at most max_train_docs ids: small by parameter, so a broadcast
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
    texts = id_text(docs, id_col, text_col).filter(F.length("text") <= max_train_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lookup(features)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for i, y, t in zip(*(part.column(c).to_pylist() for c in ("doc_id", "y", "text"))):
                    own = [sorted({f for w in s for f in known[w]}) for s in sentences(t)]
                    rows.append((i, y, np.array([f for s in own for f in s], "<i4").tobytes(),
                                 np.array([len(s) for s in own], "<i4").tobytes()))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["doc_id", "y", "feats", "sizes"])

    return (texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
            .mapInArrow(run, "doc_id bigint, y int, feats binary, sizes binary").toPandas()
            .sort_values(["doc_id", "feats"], ignore_index=True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None,
        max_train_docs: int = 6000, max_train_chars: int = 20_000, least_docs: int = 4, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Fit on the labels that ``usable`` (a condition on the labels) allows."""
    usable = F.lit(True) if usable is None else usable
    rows = training_rows(docs, labels, F.col(label), usable, max_train_docs, max_train_chars, id_col, text_col)
    y = rows["y"].to_numpy(bool) if len(rows) else np.zeros(0, bool)
    if not y.any() or y.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), -35.0)
    # Features of fewer than least_docs documents say nothing reliable. They
    # are left out document by document, which bounds the driver's memory.
    count = np.zeros(SPACE, np.int32)
    for x in rows["feats"]:
        count[np.unique(np.frombuffer(x, "<i4"))] += 1
    ids = np.flatnonzero(count >= least_docs)
    number = np.full(SPACE, -1, np.int32)
    number[ids] = np.arange(len(ids))
    feats, sent, doc, n_sent = [], [], [], 0
    for k, (x, s) in enumerate(zip(rows.pop("feats"), rows.pop("sizes"))):
        sizes = np.frombuffer(s, "<i4")
        f = number[np.frombuffer(x, "<i4")]
        own = np.repeat(np.arange(n_sent, n_sent + len(sizes), dtype=np.int32), sizes)
        feats.append(f[f >= 0])
        sent.append(own[f >= 0])
        doc.append(np.full(len(sizes), k, np.int32))
        n_sent += len(sizes)
    w, b = fit_noisy_or(np.concatenate(feats), np.concatenate(sent), np.concatenate(doc), y, len(ids))
    return Model(ids[w != 0], w[w != 0], b)


def score_column(model: Model, text: Column) -> Column:
    """The document score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        lookup = model.lookup()
        return pd.Series([model.score(t, lookup) for t in texts], dtype=float)

    return score(text.cast("string"))


def offending(docs: DataFrame, model: Model, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number and byte span (in the UTF-8 text) and score of every
    sentence scored ``least`` or more. Rows with a null text have none; the
    id of a row without one is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = model.lookup()
        for batch in batches:
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                # Lower case changes lengths, but neither makes nor takes a sentence's end.
                own, low = ((x.encode("utf-8", "surrogatepass").translate(TABLE)).split(b"\n") for x in (t or "", (t or "").lower()))
                spans, at = [], 0
                for s, lower in zip(own, low, strict=True):
                    if lower.split():
                        spans.append((at, at + len(s)))
                    at += len(s) + 1
                for k, (p, (a, b)) in enumerate(zip(model.sentence_scores(t, lookup), spans)):
                    if p >= least:
                        rows.append((i, k, a, b, float(p)))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()))],
                names=["doc_id", "sentence", "start", "end", "score"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, sentence int, start bigint, end bigint, score double")
