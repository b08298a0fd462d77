"""Benchmark decontamination (operator 3).

Every window of ``window`` consecutive normalised words of a benchmark item
(the whole item when it is shorter) is a pattern of ONE Aho-Corasick
automaton. A document is normalised to its words between single spaces and
scanned once; the automaton reports all overlapping occurrences, and their
offsets map back to word numbers and to places in the original text.

The patterns come from the benchmark, whose size does not grow with the
corpus; it is still checked: up to ``max_pattern_bytes`` of normalised item
text go into one automaton, and a larger benchmark is cut into several, each
of them the subject of its own scan.

Defined results: null text or item = no words; an item without words matches
nothing; equal items all count; an empty benchmark leaves every document
clean; repeated document rows are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

#: ASCII letters lower-cased, digits and bytes of other characters kept, all else a blank.
TABLE = bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))
#: Results: word counts, items, decision and the hit places in the original's UTF-8 bytes.
SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<start:bigint,end:bigint>>")
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def patterns_of(items: list[tuple[str, str | None]], window: int) -> dict[bytes, list[int]]:
    """Pattern (words between single blanks, and at both ends) -> item numbers."""
    out: dict[bytes, list[int]] = {}
    for k, (_, text) in enumerate(items):
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            of = out.setdefault(b" %b " % b" ".join(w[i:i + window]), [])
            if not of or of[-1] != k:
                of.append(k)
    return out


class Scanner:
    """The automaton over one set of patterns, and the scan of one document."""

    def __init__(self, patterns: dict[bytes, list[int]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for p, items in patterns.items():  # latin-1: one character a byte, so offsets are byte offsets
            self.automaton.add_word(p.decode("latin-1"), (len(p), p.count(b" ") - 1, tuple(items)))
        self.empty = not patterns
        if patterns:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(first word, word count) of each occurrence, and the items hit."""
        if self.empty or not words:
            return [], set()
        found = list(self.automaton.iter((b" %b " % b" ".join(words)).decode("latin-1")))
        if not found:
            return [], set()
        at = np.cumsum([0] + [len(w) + 1 for w in words])  # place of the blank before each word
        first = np.searchsorted(at, [end + 1 - v[0] for end, v in found])
        return [(int(i), v[1]) for i, (_, v) in zip(first, found)], {k for _, v in found for k in v[2]}


def original_spans(text: str, mask: np.ndarray) -> list[dict]:
    """Byte spans in the original text of each maximal run of hit words."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    run = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return [{"start": int(starts[a]), "end": int(ends[b - 1])}
            for a, b in zip(np.flatnonzero(run == 1), np.flatnonzero(run == -1))]


def _judge(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  max_pattern_bytes: int = 32 << 20) -> DataFrame:
    """One row per document (see ``SCHEMA``): a word inside any occurrence of
    a benchmark window is hit; contaminated when hits make up a twentieth of
    the words at least. ``docs`` is scanned once, without a shuffle."""
    chunks = item_chunks(benchmark, item_col, item_text_col, max_pattern_bytes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One automaton at a time is in memory; a benchmark within the limit has exactly one.
        scanners = [Scanner(patterns_of(c, window)) for c in chunks] if len(chunks) == 1 else None
        for batch in batches:
            for part in slices(batch):
                ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                words = [words_of(t) for t in texts]
                found: list[tuple[list, list]] = [([], []) for _ in texts]
                for k, c in enumerate(chunks):
                    s = scanners[k] if scanners else Scanner(patterns_of(c, window))
                    for f, w in zip(found, words):
                        spans, items = s.hits(w)
                        f[0].extend(spans)
                        f[1].extend(str(c[i][0]) for i in items)
                yield _rows(ids, texts, words, found)

    return id_text(docs, id_col, text_col).mapInArrow(scan, SCHEMA)


def contaminated_column(benchmark: DataFrame, text: Column, window: int = 13, item_col: str = "item_id",
                        item_text_col: str = "text", max_pattern_bytes: int = 32 << 20) -> Column:
    """The decision alone, for a text column."""
    chunks = item_chunks(benchmark, item_col, item_text_col, max_pattern_bytes)

    @F.pandas_udf("boolean")
    def judge(texts: pd.Series) -> pd.Series:
        words = [words_of(t) for t in texts]
        hit = [np.zeros(len(w), bool) for w in words]
        for c in chunks:
            s = Scanner(patterns_of(c, window))
            for w, m in zip(words, hit):
                for a, n in s.hits(w)[0]:
                    m[a:a + n] = True
        return pd.Series([_judge(len(w), int(m.sum())) for w, m in zip(words, hit)], dtype=bool)

    return judge(text.cast("string"))


def _rows(ids, texts, words, found) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in ARROW]
    for i, t, w, (spans, items) in zip(ids, texts, words, found):
        n_hit, places = 0, []
        if spans:
            d = np.zeros(len(w) + 1, np.int32)
            np.add.at(d, [a for a, _ in spans], 1)
            np.add.at(d, [a + n for a, n in spans], -1)
            mask = np.cumsum(d[:-1]) > 0
            n_hit, places = int(mask.sum()), original_spans(t, mask)
        items = sorted(items)
        row = (i, len(w), n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(),
               _judge(len(w), n_hit), items, places)
        for c, v in zip(cols, row):
            c.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ARROW)], schema=ARROW)


def item_chunks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> list[list[tuple[str, str | None]]]:
    """The items on the driver, in chunks of ``most`` bytes of text; read by
    an iterator, one partition at a time."""
    chunks, size = [[]], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator()
    for item, text in rows:
        n = len(text or "") * 4
        if chunks[-1] and size + n > most:
            chunks.append([])
            size = 0
        chunks[-1].append((item, text))
        size += n
    return chunks
