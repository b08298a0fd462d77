"""Quality rules: learned decision lists (operator 4).

:func:`statistics` computes interpretable counts of every whole text in one
scan. :func:`learn` covers the labelled bad documents sequentially: each rule
is a conjunction of thresholds grown by information gain on two thirds of the
sample and pruned on the other third; it joins the list when it is precise
enough on both, and the documents that it covers leave the sample. The list becomes one
ordered Spark conditional expression (:func:`verdict`), so applying it is a
column of the statistics, without Python.

The sample is bounded: ``max_rows`` labelled rows, the first by a hash of the
id. Statistics cover all documents.

Defined results: null or empty text = no words, all counts 0, ratios 0;
null labels are ignored; several labels of a document count as the smallest;
without labels of both kinds the list is empty and keeps everything.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_closed_lines",
          "n_marks", "n_digits", "longest_word", "n_short_lines"]
#: Ratios (count, per count) that rules may use, beside n_words.
RATIOS = {"mean_word": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
          "repeats": ("n_repeat_words", "n_words"), "words_per_line": ("n_words", "n_lines"), "distinct": ("n_distinct", "n_words"),
          "closed_lines": ("n_closed_lines", "n_lines"), "marks": ("n_marks", "n_words"), "digits": ("n_digits", "n_words"),
          "short_lines": ("n_short_lines", "n_lines")}
FEATURES = ["n_words", "longest_word", *RATIOS]
SYMBOL, MARK, DIGIT = re.compile(r"[#*$%&|<>]"), re.compile(r"[.,;:!?]"), re.compile(r"[0-9]")
BLANKS = " \t\n\x0b\x0c\r"
SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    return [w for w in SPLIT.split(text) if w]


def repeat_words(words: list[str], width: int = 5) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[k:] for k in range(width))))
    count = Counter(grams)
    if len(count) == n:
        return 0
    total, until = 0, 0
    for p, g in enumerate(grams):
        if count[g] > 1:
            total += p + width - max(p, until)
            until = p + width
    return total


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    w = words_of(text)
    lines = [s for s in text.split("\n") if s.strip(BLANKS)]
    return (len(w), sum(map(len, w)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), repeat_words(w), len(lines),
            len(set(w)), sum(s.rstrip(BLANKS)[-1] in ".!?" for s in lines), len(MARK.findall(text)), len(DIGIT.findall(text)),
            max(map(len, w), default=0), sum(len(s) < 20 for s in lines))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [counts_of(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows))],
                                                 names=["doc_id", *COUNTS])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def feature(name: str) -> Column:
    """A feature as an expression of the counts; 0 where there is nothing to divide by."""
    if name not in RATIOS:
        return F.col(name).cast("double")
    a, b = RATIOS[name]
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # feature >= threshold, else feature < threshold
    threshold: float


Rule = tuple[Test, ...]


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        v = x[:, FEATURES.index(t.feature)]
        out &= v >= t.threshold if t.above else v < t.threshold
    return out


def grow(x: np.ndarray, y: np.ndarray, most_tests: int, bins: int = 32) -> Rule:
    """Add the threshold with the largest information gain until the rule
    covers bad rows only, or nothing is gained."""
    rule: Rule = ()
    inside = np.ones(len(y), bool)
    while len(rule) < most_tests and inside.any() and not y[inside].all():
        p, n = y[inside].sum(), inside.sum()
        best = (1e-9, None)
        for k, name in enumerate(FEATURES):
            v = x[inside, k]
            for c in np.unique(np.quantile(v, np.linspace(0, 1, bins + 1))):
                for above in (True, False):
                    m = v >= c if above else v < c
                    a = y[inside][m].sum()
                    if a and m.sum() < n:
                        gain = a * (np.log2(a / m.sum()) - np.log2(p / n))
                        if gain > best[0]:
                            best = (gain, Test(name, above, float(c)))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= holds((best[1],), x)
    return rule


def pruned(rule: Rule, x: np.ndarray, y: np.ndarray) -> Rule:
    """The beginning of the rule with the best (good - bad) / covered on rows
    that it wasn't grown on."""

    def worth(r: Rule) -> float:
        m = holds(r, x)
        return (2 * y[m].sum() - m.sum()) / m.sum() if m.any() else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def cover(x: np.ndarray, y: np.ndarray, fold: np.ndarray, least_precision: float, least_rows: int, most_rules: int,
          most_tests: int) -> list[Rule]:
    """The ordered list of rules for y (bad) over feature rows x."""
    out: list[Rule] = []
    left = np.ones(len(y), bool)
    while len(out) < most_rules:
        a, b = left & (fold != 0), left & (fold == 0)
        if y[a].sum() < least_rows:
            break
        rule = pruned(grow(x[a], y[a], most_tests), x[b], y[b])
        if not rule:
            break
        hit, on_b = left & holds(rule, x), b & holds(rule, x)
        # precise on all rows and on those that it wasn't grown on
        if hit.sum() < least_rows or y[hit].mean() < least_precision or not on_b.any() or y[on_b].mean() < least_precision:
            break
        out.append(rule)
        left &= ~hit
    return out


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, least_precision: float = 0.95,
          least_rows: int = 10, most_rules: int = 12, most_tests: int = 4, id_col: str = "doc_id") -> list[Rule]:
    """Rules for label 0, from a bounded sample of labelled statistics."""
    own = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    own = own.filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
    # at most max_rows ids: small by parameter, so a broadcast
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = stats.join(F.broadcast(sample), "doc_id").select("doc_id", "y", *(feature(f).alias(f) for f in FEATURES)).toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    y = rows["y"].to_numpy() == 0
    if not y.any() or y.all():
        return []
    fold = (np.arange(len(y)) * 2654435761 >> 7) % 3
    return cover(rows[FEATURES].to_numpy(float), y, fold, least_precision, least_rows, most_rules, most_tests)


def condition(rule: Rule) -> Column:
    out = F.lit(True)
    for t in rule:
        v = feature(t.feature)
        out = out & ((v >= F.lit(t.threshold)) if t.above else (v < F.lit(t.threshold)))
    return out


def verdict(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that holds, 0 if none: one ordered
    conditional expression over the counts."""
    out = None
    for k, r in enumerate(rules, 1):
        out = F.when(condition(r), k) if out is None else out.when(condition(r), k)
    return F.lit(0) if out is None else out.otherwise(0)


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{t.feature} {'>=' if t.above else '<'} {t.threshold:.6g}" for t in r) for r in rules]


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics with base_failed, rule (0: none) and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))
