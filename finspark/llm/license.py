"""License scans by Dice coefficient over word bigrams (operator 9).

A document's lines, and the whole text when it has several, are normalised
(ASCII letters lower-cased, words of letters and digits) and compared with
license templates by the Dice coefficient of their sets of word bigrams,
2 |A & B| / (|A| + |B|). A score of ``least`` needs sizes within a factor of
(2 - least) / least, so only templates of fitting size are compared, and of
these only such as share a bigram.

With ``passages``, runs of words anywhere in the document are compared too: a
notice over several lines or inside a longer one, and a license text embedded
in a document. Only templates are tried of whose bigrams the document has as
many as the score needs. Every start (for a long template first a grid, then
the starts around its best places) is tried with every end, so no passage
that reaches ``least`` falls between two windows. A passage is left out where
it overlaps a match of the same template, or has most of its words in common
with a match of another one that scores at least as well.

Templates are a parameter; the few short notices below are the default, and
``license_texts`` has whole texts besides. They go to every task,
which is safe as their total size is checked.

Defined results: null, empty and blank texts have no segment; a segment of
one word has no bigram and matches nothing; equal scores go to the first
template by name; repeated rows are scanned each; a passage has the number of
the line in which it begins.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, slices

#: Customary one-line notices of public licenses (fixed values).
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-3-clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
MOST_TEMPLATE_BYTES = 16 << 20
WORD = re.compile(r"[a-z0-9\x80-\U0010FFFF]+")
UPPER = {c: c + 32 for c in range(65, 91)}
OUT = "doc_id bigint, segment int, license string, shared bigint, size bigint, template_size bigint, dice double"


def license_texts() -> dict[str, str]:
    """Whole license texts, by name."""
    return {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(UPPER))


def bigrams(text: str) -> set[tuple[str, str]]:
    w = words_of(text)
    return set(zip(w, w[1:]))


class Templates:
    """Templates by size, and by bigram."""

    def __init__(self, notices: dict[str, str], least: float):
        self.least = least
        self.sets = sorted((name, s) for name, t in notices.items() if (s := bigrams(t)))
        self.having = defaultdict(list)
        for k, (_, s) in enumerate(self.sets):
            for b in s:
                self.having[b].append(k)
        sizes = [len(s) for _, s in self.sets]
        self.smallest = min(sizes, default=0) * least / (2 - least)
        self.largest = max(sizes, default=-1) * (2 - least) / least

    def best(self, text: str) -> tuple[str, int, int, int, float] | None:
        """(name, shared, size, template's size, score) of the best match."""
        own = bigrams(text)
        if not own or not self.smallest <= len(own) <= self.largest:
            return None
        shared: dict[int, int] = defaultdict(int)
        for b in own:  # an intersection with the dict would walk all of the templates' bigrams
            for k in self.having.get(b, ()):
                shared[k] += 1
        found = None
        for k, n in sorted(shared.items()):
            name, s = self.sets[k]
            if min(len(s), len(own)) * (2 - self.least) >= self.least * max(len(s), len(own)):
                score = 2 * n / (len(s) + len(own))
                if score >= self.least and (found is None or score > found[4]):
                    found = (name, n, len(own), len(s), score)
        return found


    def passages(self, words: list[str], taken: list[tuple[int, int, str, float]]) -> Iterator[tuple[int, str, int, int, int, float]]:
        """(first word, name, shared, size, template's size, score) of the
        passages besides those ``taken``: (first word, end, name, score)."""
        pairs = list(zip(words, words[1:]))
        count: dict[int, int] = defaultdict(int)
        for b in self.having.keys() & set(pairs):
            for k in self.having[b]:
                count[k] += 1
        r = self.least / (2 - self.least)  # the smallest size, and share of the template's bigrams
        fit = [k for k, n in sorted(count.items()) if n >= r * len(self.sets[k][1]) - 1e-9]
        if not fit:
            return
        last: dict[tuple[str, str], int] = {}
        before = np.empty(len(pairs), np.int64)  # the place of the same bigram before
        for i, b in enumerate(pairs):
            before[i] = last.get(b, -1)
            last[b] = i
        found = []
        for k in fit:
            name, s = self.sets[k]
            own = [(a, e) for a, e, x, _ in taken if x == name]
            found += [(-x[-1], name, *x) for x in self.windows(before, np.fromiter((b in s for b in pairs), bool, len(pairs)), len(s), own)]
        for _, name, a, e, n, size, of, score in sorted(found):
            if all(min(e, y) - max(a, x) <= max(e - a, y - x) / 2 for x, y, _, best in taken if best >= score):
                taken.append((a, e, name, score))
                yield a, name, n, size, of, score

    def windows(self, before, hit, m: int, own: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int, float]]:
        """(first word, end, shared, size, m, score) of one template's
        passages, apart from each other and from ``own``."""
        most = int(m * (2 - self.least) / self.least + 1e-9)  # distinct bigrams at most
        need = self.least * m / (2 - self.least) - 1e-9  # shared bigrams at least
        step = max(1, m // 64)

        def best(s: int, stop: int) -> tuple[float, int, int, int]:
            """(score, end, shared, size) of the best window from bigram s
            on, before bigram ``stop``; ends are tried until too many differ."""
            width = most + step
            while True:
                new = before[s:min(s + width, stop)] < s
                size = np.cumsum(new)
                if s + width >= stop or not len(size) or size[-1] > most + step:
                    break
                width *= 2
            if not len(size):
                return 0.0, s, 0, 0
            shared = np.cumsum(new & hit[s:s + len(size)])
            score = 2 * shared / (size + m)
            e = int(np.argmax(score))
            return float(score[e]), s + e + 1, int(shared[e]), int(size[e])

        # A grid start adds step - 1 bigrams at most to the best window behind it.
        low = self.least * m * (1 + self.least / (2 - self.least)) / (m * (1 + self.least / (2 - self.least)) + step - 1) - 1e-9
        out, free = [], [(0, len(hit))]
        for a, e in sorted(own):  # bigrams that touch no word of an own match
            x, y = free.pop()
            free += [(x, min(a - 1, y)), (max(e, x), y)]
        while free:
            lo, hi = free.pop()
            if hi <= lo or np.count_nonzero(hit[lo:hi]) < need:
                continue
            places = np.arange(lo, hi, step) if step > 1 else lo + np.flatnonzero(hit[lo:hi])
            tried = sorted((x for x in ((*best(int(s), hi), int(s)) for s in places) if x[0] >= low), key=lambda x: (-x[0], x[-1]))
            for *_, s in tried:
                near = [t for t in range(max(lo, s - step + 1), min(s + step, hi)) if hit[t]]
                score, e, n, size, t = max(((*best(t, hi), t) for t in near), key=lambda x: (x[0], -x[-1]), default=(0, 0, 0, 0, 0))
                if score >= self.least:
                    out.append((t, e + 1, n, size, m, score))
                    free += [(lo, t - 1), (e + 1, hi)]
                    break
        return out


def scan(docs: DataFrame, notices: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id",
         text_col: str = "text", passages: bool = False) -> DataFrame:
    """One row per segment that matches a license: its line number from 0
    (-1: the whole text), the best license, sizes of the bigram sets, score;
    with ``passages`` also one per passage besides."""
    notices = NOTICES if notices is None else notices
    if sum(len(t) for t in notices.values()) > MOST_TEMPLATE_BYTES:
        raise ValueError("templates: too large to send to every task; scan in parts")
    if not 0 < least <= 1:
        raise ValueError("least: above 0, 1 at most")
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    names = ["doc_id", "segment", "license", "shared", "size", "template_size", "dice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(notices, least)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    lines = t.split("\n") if t else []
                    segments = [*enumerate(lines), *([(-1, t)] if len(lines) > 1 else [])]
                    matches = [(i, k, *m) for k, s in segments if (m := templates.best(s))]
                    rows += matches
                    if passages and lines:
                        each = [words_of(s) for s in lines]
                        ends = list(accumulate(map(len, each), initial=0))
                        taken = [(0, ends[-1], m[2], m[-1]) if m[1] < 0 else (ends[m[1]], ends[m[1] + 1], m[2], m[-1]) for m in matches]
                        rows += [(i, bisect_right(ends, a) - 1, *m) for a, *m in templates.passages([w for x in each for w in x], taken)]
                cols = list(zip(*rows)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return id_text(docs, id_col, text_col).mapInArrow(run, OUT)
