"""Operators 3, 4, 5 and 9."""

import hashlib
import random

import brute
import numpy as np
import pytest

from finspark.llm import decontaminate, license, rules, toxicity


def test_decontamination_matches_brute_force(spark, docs_of):
    r = random.Random(4)
    words = [f"w{k}" for k in range(50)] + ["Été", "X1"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k))
    items = [(k, text(r.choice([3, 13, 14, 30]))) for k in range(12)] + [(20, None), (21, "--"), (22, "Solo"), (23, "solo!")]
    rows = [(i, text(40) + (f", ({items[i % 12][1].upper()}) " if i % 2 else " ") + text(r.choice([0, 30, 400]))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "..."), (93, "a SOLO b"), (93, "a SOLO b")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.decontaminate(docs_of(rows), bench).collect()
    want = brute.contaminated(rows, items)
    assert len(got) == len(rows)
    for x in got:
        n, hit, of, bad = want[x.doc_id]
        assert (x.n_words, x.n_hit, x.n_items, x.items, x.contaminated) == (n, hit, len(of), of, bad)
        assert x.items_sha256 == hashlib.sha256(",".join(of).encode()).hexdigest()
        raw = (dict(rows)[x.doc_id] or "").encode()
        assert sum(len(decontaminate.words_of(raw[s.start:s.end].decode())) for s in x.spans) == hit
    docs = docs_of(rows)
    kept = docs.filter(~decontaminate.contaminated_column(bench, docs.text))
    assert sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in rows if not want[i][3])
    # several automata give what one gives
    many = decontaminate.decontaminate(docs, bench, max_pattern_bytes=300).select("doc_id", "n_hit", "items_sha256")
    assert sorted(many.collect()) == sorted((x.doc_id, x.n_hit, x.items_sha256) for x in got)


def test_decontamination_without_rows(spark, docs_of):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    got = decontaminate.decontaminate(docs_of([(1, "a b")]), bench).collect()
    assert [(x.n_words, x.n_hit, x.contaminated) for x in got] == [(2, 0, False)]
    assert decontaminate.decontaminate(docs_of([]), bench).count() == 0


def test_rule_statistics():
    t = "a b c d e a b c d e\nx #|\n\nx #|\n x #|"
    c = dict(zip(rules.COUNTS, rules.counts_of(t)))
    assert (c["n_words"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"], c["word_chars"]) == (16, 6, 1, 10, 19)
    assert rules.counts_of(None) == rules.counts_of("") == (0,) * len(rules.COUNTS)
    r = random.Random(1)
    for _ in range(200):
        w = [r.choice("ab") for _ in range(r.randint(0, 14))]
        grams = [tuple(w[p:p + 5]) for p in range(len(w) - 4)]
        cov = {p + k for p, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert rules.repeat_words(w) == len(cov)


def labelled(docs_of, spark, n=300):
    r = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeio" for c in "lmnr"]
    sentence = lambda k: " ".join(r.choice(words) for _ in range(k)) + "."
    rows, labels = [], []
    for i in range(n):
        s = [sentence(r.randint(4, 12)) for _ in range(r.randint(2, 8))]
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            s[r.randrange(len(s))] = sentence(3)[:-1] + r.choice([" vile", " nasty", " nastyish"]) + "."
        t = " ".join(s)
        if bad:
            t = " ".join(f"{w} ##%%" for w in t.split(" "))
        rows.append((i, t))
        labels.append((i, int(not bad), int(toxic)))
    return docs_of(rows + [(990, None), (991, "")]), spark.createDataFrame(
        labels + [(5000, 1, 1), (None, 0, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


def test_rules_learn_and_keep_clean(spark, docs_of):
    docs, labels = labelled(docs_of, spark)
    stats = rules.statistics(docs)
    learned = rules.learn(stats, labels)
    assert learned and rules.describe(learned)
    got = {x.doc_id: x for x in rules.apply_rules(stats, learned).collect()}
    assert len(got) == 302 and got[990].base_failed and not got[990].kept and got[991].n_words == 0
    long_enough = [i for i in range(300) if not got[i].base_failed]
    assert all(got[i].kept for i in long_enough if i % 5) and not any(got[i].kept for i in long_enough if i % 5 == 0)
    # the expression says what the rules say on numbers
    x = np.array([[float(v) for v in r] for r in stats.select(*(rules.feature(f) for f in rules.FEATURES)).collect()])
    first = np.zeros(len(x), int)
    for k, rule in reversed(list(enumerate(learned, 1))):
        first[rules.holds(rule, x)] = k
    assert sorted(first) == sorted(r.rule for r in got.values())


def test_rules_without_labels(spark, docs_of):
    stats = rules.statistics(docs_of([(1, "a b c d e f g h i j k")]))
    learned = rules.learn(stats, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"))
    assert learned == [] and rules.apply_rules(stats, learned).first().kept
    assert rules.statistics(docs_of([])).count() == 0


def test_toxicity_held_out_and_sentences(spark, docs_of):
    docs, labels = labelled(docs_of, spark, 600)
    model = toxicity.fit(docs, labels, usable=labels.doc_id % 3 != 0)
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score_column(model, docs.text).alias("s")).collect()}
    assert got[990] == got[991] == 0.0 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(0, 600, 3)]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in held) / len(held) > 0.95
    found = toxicity.offending(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    right = [any(w in texts[r.doc_id].lower().encode()[r.start:r.end] for w in (b"vile", b"nasty")) for r in found]
    assert len(right) > 100 and sum(right) / len(right) > 0.95


def test_offending_spans_are_of_the_text_itself(spark, docs_of):
    docs, labels = labelled(docs_of, spark, 400)
    model = toxicity.fit(docs, labels)
    text = "İİİİ is one place. You VILE nasty thing! ẞ \u212a fine\nAll good."
    found = toxicity.offending(docs_of([(1, text), (2, None), (None, "You nasty VILE thing"), (3, "")]), model).collect()
    cut = {r.doc_id: text.encode()[r.start:r.end].decode() for r in found if r.doc_id}
    assert cut == {1: " You VILE nasty thing"} and [r for r in found if r.doc_id is None]


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of([(1, "a b."), (2, None)])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(r.s < 1e-9 for r in docs.select(toxicity.score_column(model, docs.text).alias("s")).collect())


def test_noisy_or_gradient_lowers_the_loss():
    r = np.random.default_rng(2)
    feats, sent = r.integers(0, 30, 4000), np.sort(r.integers(0, 800, 4000))
    doc = np.sort(r.integers(0, 200, 800))
    y = np.isin(np.arange(200), doc[sent[feats == 3]])
    w, _ = toxicity.fit_noisy_or(feats, sent, doc, y, 30)
    assert np.argmax(w) == 3 and w[3] > 2


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_license_scan_matches_brute_force(docs_of, least):
    lines = [*license.NOTICES.values(), "Released  under the MIT LICENSE!", "Released under the MIT license today", "the", "",
             "This work is licensed under the GNU General Public License, version 2."]
    rows = [(i, t) for i, t in enumerate(lines)] + [(50, "\n".join(lines)), (51, None), (52, "\n"), (50, lines[0])]
    got = sorted((r.doc_id, r.segment, r.license, r.dice) for r in license.scan(docs_of(rows), least=least).collect())
    want = []
    for i, t in rows:
        segments = list(enumerate((t or "").split("\n")))
        for k, s in segments + ([(-1, t)] if len(segments) > 1 else []):
            a = license.bigrams(s)
            scores = [(2 * len(a & (b := license.bigrams(n))) / (len(a) + len(b)), name) for name, n in license.NOTICES.items()]
            top = max(s for s, _ in scores)
            if top >= least:
                want.append((i, k, min(n for s, n in scores if s == top), top))
    assert got == sorted(want) and want


def test_license_limits(docs_of):
    with pytest.raises(ValueError):
        license.scan(docs_of([]), notices={"x": "y" * (17 << 20)})
    assert license.scan(docs_of([]), notices={}).count() == 0
    assert license.scan(docs_of([(1, "a b")]), notices={}).count() == 0


def test_license_passages(docs_of):
    texts = license.license_texts()
    assert {"mit-text", "gpl-3-text", "apache-2.0-text", "mpl-2.0-text"} <= set(texts)
    r = random.Random(11)
    prose = lambda k: " ".join(r.choice(["under", "the", "license", *(f"w{x}" for x in range(300))]) for _ in range(k))
    mpl, bsd = license.NOTICES["mpl-2.0"], license.NOTICES["bsd-3-clause"]
    rows = [(1, f"{prose(30)}\n# {mpl[:50]}\n# {mpl[50:]}\n{prose(30)}"),  # over two lines
            (2, f"{prose(40)} {bsd} {prose(40)}"),  # inside a longer line
            (3, f"{prose(300)}\n{texts['mit-text']}\n{prose(300)}"), (4, texts["gpl-3-text"]),  # embedded, alone
            (5, f"{prose(90)}\n{texts['gpl-3-text']}\n{prose(4000)}"),
            (6, f"{mpl}\n{prose(9)}"), (7, prose(500)), (8, None), (9, "")]
    rows += [(10, f"{prose(20)} {mpl.replace('subject', 'x y z subject')} {prose(20)} {bsd} {prose(20)}")]  # two, one with words put in
    templates = license.NOTICES | texts
    got = sorted((x.doc_id, x.segment, x.license) for x in license.scan(docs_of(rows), templates, passages=True).collect())
    assert got == [(1, 1, "mpl-2.0"), (2, 0, "bsd-3-clause"), (3, 1, "mit-text"), (4, -1, "gpl-3-text"), (5, 1, "gpl-3-text"),
                   (6, 0, "mpl-2.0"), (10, 0, "bsd-3-clause"), (10, 0, "mpl-2.0")]
