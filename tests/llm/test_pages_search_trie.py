"""Operators 11, 12 and 13."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from finspark.llm import prefixes, ranked, tagpaths

# --- 11: main text ----------------------------------------------------------

MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
LONG = "We use cookies, as all do, to make this site work. By reading on you agree to them, and to all of our partners."
PAGES = [
    (None, ""),
    ("", ""),
    ("no tags &amp; no blocks", "no tags & no blocks"),
    ("<title>T</title><p>One, two.<p>Three &lt;b&gt;.", "One, two. Three <b>."),
    (f"{MENU}<header>Site</header><article><h1>Head</h1><p>Some <b>bo</b>ld\n\t text.</p><ul><li>a</li><li>b</ul>tail</article>"
     f"<footer>&copy; x</footer>", "Head Some bold text. a b tail"),
    (f"<div class='cookie-notice'><p>{LONG}</p></div><article><p>Short.</p></article>", "Short."),
    (f"<main><h1>T</h1><p>Text here, of some words.</p><section id=comments><p>{LONG}</p><p>{LONG}</p></section></main>",
     "T Text here, of some words."),
    (f"<article><p>A, b.</p></article><aside><p>{LONG}</p></aside><article class='comment'><p>{LONG}</p></article>", "A, b."),
    (f"<div id=site-header><p>{LONG}</p></div><div class='post has-sidebar'><h2>T</h2><p>First words, then more.</p><p>End.</p></div>"
     f"<div class=sidebar><p>{LONG}</p></div><form><p>{LONG}</p></form>", "T First words, then more. End."),
    # a list of links beside the text, without any word that tells
    ("<div><div><a href=1>One link here</a></div><div><a href=2>Another link there</a></div></div>"
     "<div><h1>Title</h1><p>A sentence, which is long enough to be text. And one more, for the ratio.</p><p>Last.</p></div>",
     "Title A sentence, which is long enough to be text. And one more, for the ratio. Last."),
    ("<article><p>Cut short, in a ta</p><p>unfinished <b", "Cut short, in a ta unfinished"),
    ("<article><p>x<!-- no <p>text</p> -->y</p><script>var a = '</p><p>no'; if (1 < 2) b();</script><style>p{}</style><p>z &am</p>",
     "xy z &am"),
    ("<article><p><b>one<br><p>two</p><p><b>three<br><p>four</p></article><div class=ad>Buy, buy.</div>", "one two three four"),
    ("<article><header><h1>Inner head</h1></header><p>Words.</p><footer>by me</footer></article>", "Inner head Words."),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><p>3 &lt; 4 &amp; 5 > 4</p></article>", "a b c 3 < 4 & 5 > 4"),
    ("<ARTICLE><P TITLE='a > b'>Up&nbsp;per, case.</P></ARTICLE><DIV CLASS='AdBox'>x, y, z.</DIV>", "Up per, case."),
    ("<article></article><div class='ad'>Only an advert, nothing else.</div>", ""),
    ("<form action=x><div><article><p>The page is one form.</p></article></div></form>", "The page is one form."),
    ("<body class='no-menu page'><div class='header'><h1>Site</h1></div><article><p>Hé, ça va.</p></article></body>", "Hé, ça va."),
    ("<p hidden>not seen, not read.</p><article><p>seen</p><div style='display: none'>x</div></article>", "seen"),
]


def test_main_text_of_planted_pages(spark):
    for html, want in PAGES:
        assert tagpaths.main_text(html)[0] == want, html
    rows = [(k, f"u{k}", h, "x", 1) for k, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[3][0], "x", 1), (3, "u3", PAGES[3][0], "y", 2)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int").repartition(3)
    got = tagpaths.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        want = PAGES[3 if r.page_id is None else r.page_id][1]
        assert (r.text, r.n_chars) == (want, len(want)) and r.url == (None if r.page_id is None else f"u{r.page_id}")
    assert tagpaths.extract(pages.limit(0)).count() == 0


def test_main_text_loses_nothing_of_an_article():
    r = random.Random(5)
    for _ in range(200):
        words = lambda n: " ".join(r.choice("abcdefgh") * r.randint(1, 9) for _ in range(n))
        blocks = [words(r.randint(1, 60)) + r.choice(["", ".", ", and."]) for _ in range(r.randint(1, 12))]
        tags = [r.choice(["p", "h2", "li", "blockquote", "div", "pre"]) for _ in blocks]
        inner = "".join(f"<{t}>{b}</{t}>" for t, b in zip(tags, blocks))
        junk = [f"<div class='{r.choice(['ad', 'sidebar-left', 'cookieBanner', 'comments'])}'><p>{words(80)}, {words(9)}.</p></div>", MENU,
                f"<footer><p>{words(50)}.</p></footer>"]
        r.shuffle(junk)
        outer = r.choice(["article", "main", "div class=text"])
        html = f"{junk[0]}<{outer}>{inner}</{outer.split()[0]}>{junk[1]}{junk[2]}"
        assert tagpaths.main_text(html)[0] == " ".join(blocks), html


def test_very_long_and_broken_pages():
    text = "word, " * 300_000
    assert len(tagpaths.main_text(f"<article><p>{text}</p></article>")[0]) == len(text.strip())
    assert tagpaths.main_text("<div>" * 20_000 + "deep, text.")[0] == "deep, text."
    for html in ("<", "<a", "</", "<!--", "<![", "<p class='", "<script>", "</div></p>x", "<p =\"a>b", "&#0;&#xD800;&bogus;", "<>x"):
        tagpaths.main_text(html)
    for _ in range(3):
        raw = [random.Random(7).choice("<>/='\" abp!-&;") for _ in range(3000)]
        tagpaths.main_text("".join(raw))


# --- 12: ranked search ------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def ranking(rows, items, k=10):
    docs = [(i, TERM.findall(lower(t))) for i, t in rows]
    n_docs, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out, asked = [], defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall(lower(t)))
    for i, terms in asked.items():
        scored = []
        for d, w in docs:
            tf, m = Counter(w), 100 - 90 + (90 * len(w) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in terms if tf[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_matches_brute_force(spark, docs_of):
    r = random.Random(2)
    words = [f"w{k}" for k in range(200)] + ["Été", "ÀB", "x9", "日本"]
    text = lambda k: ", ".join(r.choice(words[:r.choice([5, 40, 204])]) for _ in range(k))
    rows = [(i, text(r.choice([1, 5, 40, 300])) + (" the" * r.randint(0, 3))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "..."), (203, "w0 w0"), (204, "w0 w0"), (205, "THE The"), (None, "w0 w0"), (203, "w0 w0")]
    items = [(k, text(r.choice([1, 3, 12]))) for k in range(25)] + [(30, None), (31, "--"), (32, "unheard of"), (33, "the w0"), (33, "W1")]
    bench = spark.createDataFrame([(i, t, 7, "s") for i, t in items], "item_id bigint, text string, doc_id int, score string")
    want = ranking(rows, items)
    docs = docs_of(rows)
    for args in ({}, {"short": 1}, {"short": 30, "postings": 100}, {"most_bytes": 200}):
        got = ranked.search(docs, bench, **args)
        assert sorted((tuple(x) for x in got.collect()), key=str) == want, args
    few = ranked.search(docs, bench, k=3)
    assert sorted((tuple(x) for x in few.collect()), key=str) == ranking(rows, items, 3)


def test_search_of_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert ranked.search(docs_of([]), bench).count() == 0
    assert ranked.search(docs_of([(1, None)]), bench).count() == 0
    assert ranked.search(docs_of([(1, "a b"), (2, "c")]), bench.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ranked.search(docs_of([]), bench, k=0)


def test_best_equals_summing_all_lists():
    r = np.random.default_rng(3)
    for step in range(200):
        lists = []
        for _ in range(r.integers(1, 9)):
            doc = np.unique(r.integers(0, 300, r.integers(1, 250)))
            score = r.integers(1, r.choice([3, 50, 2000]), len(doc))
            lists.append((doc, score, int(score.max())))
        total = Counter()
        for d, s, _ in lists:
            for x, y in zip(d.tolist(), s.tolist()):
                total[x] += y
        want = sorted(total.items(), key=lambda x: (-x[1], x[0]))[:5]
        doc, score = ranked.best(lists, 5, int(r.choice([1, 100, 1000])), int(r.choice([1, 16, 4096])))
        assert list(zip(doc.tolist(), score.tolist())) == want


# --- 13: prefix trie --------------------------------------------------------

def plain_trie(turns):
    """(conv_id, turn, role, text) -> the contract's rows."""
    convs = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append(((t is not None, t or 0), key, (role, text)))
    convs = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, p in rebuilt.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in below)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(m) if rebuilt[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id int, turn int, role string, text string, depth string, turns int, path int"


def nodes_of(turns, **args):
    out = prefixes.trie(prefixes.shared_heads(prefixes.turn_paths(turns)), **args)
    assert out.columns == [*prefixes.COUNTS, "ends_sha256"]
    return sorted((tuple(x) for x in out.collect()), key=str)


def test_trie_matches_brute_force(spark):
    r = random.Random(11)
    rows = []
    for c in range(180):
        if c in (40, 60):  # groups without their first conversation
            continue
        for t in range(r.choice([0, 1, 2, 3, 6]) if c % 3 else 2):  # a third begin and go on alike
            same = c % 3 == 0
            rows.append((c, t, "user" if t % 2 == 0 else "bot", "hot turn of all" if same else r.choice(["yes", "no no", "maybe so", ""])))
    rows += [(300, None, None, "first of all"), (300, 0, "user", None), (300, 0, "user", None), (None, 1, "user", "nobody's"),
             (321, 5, "bot", "the last"), (321, None, "user", "the first"), (322, 1, "user", "a\tb\x0bc d")]
    rows += [(340, t, "user", f"long {t}") for t in range(120)] + [(341, t, "user", f"long {t}") for t in range(118)]
    r.shuffle(rows)
    turns = spark.createDataFrame([(*x, "d", 1, 2) for x in rows], TURNS).repartition(4)
    want = plain_trie(rows)
    for shard_rows in (50_000, 40, 3, 1):
        assert nodes_of(turns, shard_rows=shard_rows) == want, shard_rows


def test_trie_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(100) for t in range(3)]
    turns = spark.createDataFrame([(*x, "d", 1, 2) for x in rows], TURNS)
    nodes = list(prefixes.read_shard(((c, b"x" * 16, [2]) for c in range(10)), prefixes.Skeleton([b"x" * 16])))
    assert [len(x[-1]) // 8 for x in nodes if x[0] == prefixes.IDS] == [3, 3, 3, 1]
    want = plain_trie(rows)
    assert nodes_of(turns, shard_rows=10) == want and nodes_of(turns) == want


def test_trie_of_no_turns(spark):
    assert nodes_of(spark.createDataFrame([], TURNS)) == []
    assert nodes_of(spark.createDataFrame([(None, 1, "a", "b", "", 1, 1)], TURNS)) == []
    # a conversation whose own turns all go, with no first one of its group: a member of the root
    lone = next(c for c in range(100_001, 100_020) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = nodes_of(spark.createDataFrame([(lone, 0, "user", "x", "", 1, 1)], TURNS))
    assert got == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
