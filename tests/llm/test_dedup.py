"""Operators 1, 7 and 10 against plain versions, with the odd rows."""

import random

import brute
import numpy as np
import pytest

from finspark.llm import common, components, minhash, substring, suffix

ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "one"), (905, "é " * 3),
       (906, " ".join(f"l{k}" for k in range(30_000)))]


def corpus(seed=1, n=60, vocab=400):
    """Texts that share passages, are near or exact copies, or repeat in themselves."""
    r = random.Random(seed)
    words = [f"{r.choice('abcdé')}{k}" for k in range(vocab)]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    common = [text(45), text(120)]
    rows = []
    for i in range(n):
        t = text(r.choice([5, 19, 20, 60, 150]))
        if i % 3 == 0:
            t = f"{t}\n{r.choice(common)} {text(15)}"
        if i % 11 == 5:
            t = rows[-1][1]
        if i % 13 == 7:
            w = rows[-1][1].split(" ")
            w[len(w) // 2] = "zz"
            t = " ".join(w)
        if i % 17 == 3:
            t = f"{t} {t}"
        rows.append((i, t))
    return rows + ODD


def test_substring_matches_brute_force(docs_of):
    rows = corpus()
    want = brute.substring(rows)
    got = substring.substring_dedup(docs_of(rows), group_bytes=2000).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    assert sum(x[1] for x in want.values()) > 0
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


@pytest.mark.parametrize("window", [2, 3, 7])
def test_substring_other_windows(docs_of, window):
    r = random.Random(window)
    rows = [(i, " ".join(r.choice("abc") for _ in range(30))) for i in range(12)]
    got = substring.substring_dedup(docs_of(rows), window=window, group_bytes=100).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept) for x in got} == brute.substring(rows, window)


def test_packed_ids():
    for ids in ([5], [-3, 9, 4], [-(1 << 62), 1 << 62], [7, 7 + (1 << 32)]):
        a = np.array(ids, np.int64)
        assert (substring.long_ids(*substring.short_ids(a), len(a)) == a).all()
    assert len(substring.short_ids(np.array([1 << 40, 1 + (1 << 40)]))[1]) == 8


def test_substring_empty_table_and_repeated_rows(docs_of):
    assert substring.substring_dedup(docs_of([])).count() == 0
    t = " ".join(map(str, range(25)))
    got = substring.substring_dedup(docs_of([(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 25), (2, 25)]


def test_rows_without_an_id(docs_of):
    t = " ".join(f"w{k}" for k in range(150))
    rows = [(3, t), (None, t), (None, "x"), (None, None), (4, t + " y")]
    got = substring.substring_dedup(docs_of(rows)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in got) == [(-1, 0, 0), (-1, 1, 0), (-1, 150, 150), (3, 150, 0), (4, 151, 150)]
    got = suffix.remove_repeats(docs_of(rows)).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (-1, 0), (-1, 0), (3, len(t)), (4, len(t))]
    assert suffix.without_repeats(docs_of(rows)).count() == 5
    got = minhash.near_duplicates(docs_of(rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True)] * 3 + [(3, 3, True), (4, 3, False)]


def test_many_rows_without_an_id(docs_of):
    """They are dealt to groups like others; among them the first by text keeps a passage."""
    r = random.Random(5)
    shared = " ".join(f"w{k}" for k in range(30))
    tails = [" ".join(r.choice("abcdefgh") * 3 for _ in range(r.randrange(40))) for _ in range(60)]
    unnamed = sorted(f"{r.randrange(10**6)} {shared} {t}" for t in tails) + [shared, shared]
    named = [(i, f"{i} {shared[: 60 + i]} {t}") for i, t in enumerate(tails)]
    rows = named + [(None, t) for t in unnamed] + [(None, None), (None, "")]
    want = brute.substring(named + [(1000 + k, t) for k, t in enumerate(sorted(unnamed))])
    docs = docs_of(rows, 7)
    got = substring.substring_dedup(docs, group_bytes=2000).collect()
    assert len(got) == len(rows)
    whole = [(r.doc_id if r.doc_id is not None else 1000, r.n_removed, r.kept) for r in got if r.n_words]
    assert sorted(whole) == sorted((min(i, 1000), gone, kept) for i, (n, gone, kept) in want.items())
    groups = common.grouped(substring.with_ids(docs.select("doc_id", "text"))[0], 2000)[0]
    assert max(r["count"] for r in groups.groupBy("_g").count().collect()) < 20


def byte_rows(seed=3):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice("abcdefgh \né") for _ in range(k))
    common = [text(300), text(130)]
    rows = [(i, text(r.choice([10, 100, 250])) + (r.choice(common) if i % 2 else "") + text(40)) for i in range(40)]
    copy = text(300)
    rows += [(50, copy), (51, copy), (52, "ab" * 200), (53, "q" * 300), (54, "q" * 150 + "ab" * 60)]
    return rows + ODD


@pytest.mark.parametrize("shard", [1 << 20, 3000])
def test_suffix_matches_brute_force(docs_of, shard):
    """With small shards every common passage is spread over several."""
    rows = byte_rows()
    want = brute.byte_repeats(rows, 100)
    got = suffix.remove_repeats(docs_of(rows), length=100, group_bytes=1500, shard_bytes=shard).collect()
    assert len(got) == len(rows)
    for r in got:
        raw, gone = dict(rows)[r.doc_id] or "", want[r.doc_id]
        kept = bytes(b for b, g in zip(raw.encode(), gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(gone), sum(gone), runs, kept), r.doc_id
    assert sum(map(sum, want.values())) > 0


@pytest.mark.parametrize("size", [399, 400])
def test_suffix_cuts_from_400_bytes_on(docs_of, size):
    """Passages of over 50 words planted in other documents: their bytes decide, not their words."""
    r = random.Random(size)
    word = lambda k: "".join(r.choice("abcdefghij") for _ in range(k))
    passages = [" ".join([*(word(5) for _ in range(66)), word(size - 396)]) for _ in range(6)]
    assert {len(p.encode()) for p in passages} == {size} and min(len(p.split()) for p in passages) > 50
    rows = [(10 * i + k, f"{word(30)} {chr(65 + 2 * k)}{p}{chr(66 + 2 * k)} {word(30)}") for i, p in enumerate(passages) for k in range(3)]
    got = suffix.remove_repeats(docs_of(rows)).collect()
    assert {x.n_removed for x in got} == {size if size >= 400 else 0} and len(got) == len(rows)


def test_suffix_long_text_is_cut_into_chunks(docs_of, monkeypatch):
    """Executors import the module anew, so the chunks are tried without Spark."""
    monkeypatch.setattr(suffix, "CHUNK", 500)
    import pyarrow as pa

    raw = np.random.default_rng(1).integers(97, 100, 3000).astype(np.uint8).tobytes().decode()
    seen = []
    for lot in suffix.chunks(pa.table({"doc_id": [1], "text": [raw]}), 100):
        _, first, part, p1, p2, *_ = suffix.spans_of(lot, 100)
        for k, a, b in zip(part, p1, p2):
            seen += range(lot[k][2] + a - first[k], lot[k][2] + b - first[k] + 1)
    assert seen == list(range(3000 - 99))


def test_suffix_array_and_kasai():
    sym = np.frombuffer(b"mississippi$banana$mississippi", np.uint8).astype(np.uint16)
    sa, key = suffix.suffix_array(sym)
    raw = bytes(sym.astype(np.uint8))
    # beyond the end counts as larger than any symbol, as the separator does
    assert list(sa) == sorted(range(len(raw)), key=lambda i: [*raw[i:], 256])
    lcp = suffix.kasai(sym, sa, key, np.array([0]), np.array([len(raw)]), 50)
    for a, b in zip(sa[:-1], sa[1:]):
        n = 0
        while b + n < len(raw) and a + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        assert lcp[b] == n


def test_suffix_stage_keeps_columns(docs_of):
    rows = byte_rows()
    docs = docs_of(rows)
    out = suffix.without_repeats(docs, length=100)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[900] is None and texts[50] == "" and texts[901] == ""


def test_empty_tables(docs_of):
    assert suffix.remove_repeats(docs_of([])).count() == 0
    assert minhash.near_duplicates(docs_of([])).count() == 0


def test_minhash_matches_all_pairs(docs_of):
    rows = corpus(seed=5, n=80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == brute.links(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_minhash_chain_of_near_copies(docs_of):
    """Neighbours are linked, the ends are not alike: one component."""
    w = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(40):
        w = w[2:] + [f"n{i}", f"m{i}"]
        rows.append((100 - i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute.links(rows).items()} and set(got.values()) == {61}


def test_minhash_star_without_leader(docs_of):
    """Copies that are like one document but not like each other."""
    base = [f"w{k}" for k in range(100)]
    r = random.Random(2)
    rows = [(500, " ".join(base))]
    for i in range(60):
        w = list(base)
        for k in r.sample(range(100), 5):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute.links(rows).items()}


def test_rest_finds_what_the_leader_missed(spark, docs_of):
    """1 and 2 are alike; they only met 9, which is like neither."""
    base = [f"w{k}" for k in range(200)]
    texts = {1: " ".join(base), 2: " ".join([*base[:195], "x"]), 3: " ".join(base[:100] + [f"y{k}" for k in range(100)]), 4: ""}
    docs = docs_of([*texts.items(), (1, "another row of the id")]).select("doc_id", "text")
    fp = {i: minhash.fp64(minhash.shingles(t, 2)) for i, t in texts.items()}
    met = spark.createDataFrame([(9, 0, i, fp[i], 1) for i in (1, 2, 3)] + [(8, 0, 1, fp[1], 1)], minhash.MEETINGS)
    labels = spark.createDataFrame([(3, 3), (9, 3)], "node bigint, component bigint")
    got = minhash.rest_links(docs, met, labels, 2, 80, 64, 8).collect()
    assert [tuple(sorted(r)) for r in got] == [(1, 2)]
    settled = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node bigint, component bigint")
    assert minhash.rest_links(docs, met, settled, 2, 80, 64, 8).count() == 0


def test_sketch_estimates_similarity():
    r = np.random.default_rng(3)
    u = r.integers(0, 1 << 63, 900).astype(np.uint64)
    a, b = np.unique(u[:600]), np.unique(u[300:])  # 300 of 900
    s = minhash.sketches([a, b, a[:1], a[:3]], 512)
    assert (s != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.08
    assert (minhash.sketches([a], 512)[0] == s[0]).all()


def test_components(spark):
    edges = [(k + 1, k) for k in range(30)] + [(100, 101), (101, 100), (50, 50), (60, 200), (200, 70)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100, 60: 60, 200: 60, 70: 60}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
