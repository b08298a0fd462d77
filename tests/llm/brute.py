"""Plain single-process versions of the operators' contracts, for tests."""

from __future__ import annotations

import re
from collections import defaultdict

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def substring(rows, window=20):
    """(doc_id, text) -> {doc_id: (n_words, n_removed, kept text)}."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = BLANKS.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if k in seen:
                gone[p:p + window] = [True] * window
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def byte_repeats(rows, length=400):
    """(doc_id, text) -> {doc_id: removed mask (list of bool)}."""
    where = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for p in range(len(b) - length + 1):
            where[b[p:p + length]] += 1
    out = {}
    for i, b in data:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if where[b[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        out[i] = gone
    return out


def contaminated(rows, items, window=13):
    """{doc_id: (n_words, n_hit, sorted item ids, contaminated)}."""
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return pat.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    grams = defaultdict(set)
    for k, t in items:
        w = words(t)
        for p in range(max(1, len(w) - window + 1)) if w else ():
            grams[tuple(w[p:p + window])].add(str(k))
    sizes = {len(g) for g in grams}
    out = {}
    for i, t in rows:
        w = words(t)
        hit, of = [False] * len(w), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p:p + n])) in grams:
                    hit[p:p + n] = [True] * n
                    of |= grams[g]
        h = sum(hit)
        out[i] = (len(w), h, sorted(of), h > 0 and 20 * h >= len(w))
    return out


def links(rows, share=80):
    """{doc_id: (set size, component id)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = BLANKS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w)} if len(w) == 1 else {tuple(w[p:p + 2]) for p in range(len(w) - 1)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * (n := len(x & y)) >= share * (len(x) + len(y) - n):
                p, q = sorted((find(ids[a]), find(ids[b])))
                parent[q] = p
    return {i: (len(s), find(i)) for i, s in sets.items()}
