"""The registered queries: oracle SQL on the driver's smallest tables, and the
pipeline against its stages done plainly."""

import os

import brute
import pytest

import __spark_entry__ as E
import corpus_pipeline
from finspark.llm.queries import ORACLE, QUERIES
from finspark.plans.verify import compare

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ok, why = compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df())
    assert ok, why


@data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op9_license_scan", "op11_html_extraction"}))
def test_query_covers_its_table(spark, name):
    out = QUERIES[name](spark, SF)
    assert out.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_all_are_registered():
    assert set(QUERIES) <= set(E.queries()) and "pipeline" in E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_on_planted_cases(spark, docs_of, folder):
    import random

    r = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k)) + "."
    passage, item = text(120), text(20)
    rows = [(i, text(60)) for i in range(80)]
    rows += [(100 + i, f"{text(30)} vile {text(2)[:-1]} nasty. {text(30)}") for i in range(40)]  # toxic
    rows += [(200, rows[0][1]), (201, rows[1][1] + " extra")]  # copies
    rows += [(300 + i, f"{text(40)} {passage} {text(40)}") for i in range(5)]  # a shared passage
    rows += [(400, f"{text(50)} {item}"), (500, None), (501, "")]
    labels = [(i, int(100 <= i < 200)) for i, _ in rows if i < 500]
    at = folder(documents=docs_of(rows), labels=spark.createDataFrame(labels, "doc_id bigint, toxic int"),
                benchmark=spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, at)
        if name != "best_fit_packing":
            assert docs.columns == columns
            seen.append({x.doc_id: x.text for x in docs.collect()})
    ids = {i for i, _ in rows}
    toxic = {i for i in ids if 100 <= i < 200}
    assert set(seen[0]) == ids - toxic
    linked = brute.links([(i, t) for i, t in seen[0].items()])
    assert set(seen[1]) == {i for i, (_, c) in linked.items() if c == i} and {200, 201}.isdisjoint(seen[1])
    gone = brute.byte_repeats(list(seen[1].items()), corpus_pipeline.REPEAT_BYTES)
    for i, t in seen[2].items():
        want = bytes(b for b, g in zip((seen[1][i] or "").encode(), gone[i]) if not g).decode("utf-8", "ignore")
        assert (t or "") == want
    assert passage not in seen[2][300]
    assert set(seen[3]) == set(seen[2]) - {400}
    out = docs.collect()
    assert {x.doc_id for x in out} == set(seen[3])
    final = corpus_pipeline.run(spark, at)
    cols = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, final.select(*cols).collect())) == sorted(tuple(x[c] for c in cols) for x in out)


def test_pipeline_with_repeated_rows_and_shared_ids(spark, docs_of, folder):
    import random

    r = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"]
    text = lambda k: " ".join(r.choice(words) for _ in range(k)) + "."
    twice, copied, only, under_one, without = (text(150) for _ in range(5))
    rows = [(i, text(120)) for i in range(10, 30)]
    rows += [(40, twice), (40, twice), (1, copied), (41, copied + " extra"), (41, only)]
    rows += [(42, under_one), (42, under_one + " more"), (43, None), (43, None), (44, " "), (44, " ")]
    rows += [(None, without), (None, without), (None, None)]
    docs = docs_of(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(x.doc_id, x.text) for x in kept.collect()]
    of = lambda i: sorted((t for k, t in got if k == i), key=str)
    assert of(40) == [twice] and of(1) == [copied] and of(41) == [only]
    assert len(of(42)) == 1 and of(42)[0] in (under_one, under_one + " more")
    assert of(43) == [None] and of(44) == [" "] and of(None) == sorted([without, without, None], key=str)
    assert sorted(x for x in got if x[0] in range(10, 30)) == sorted(rows[:20])
    # no stage after it takes the only copy
    cut = corpus_pipeline.cut_repeats(spark, kept, "")
    assert sorted(((x.doc_id, x.text) for x in cut.collect()), key=str) == sorted(got, key=str)
    at = folder(documents=docs, labels=spark.createDataFrame([], "doc_id bigint, toxic int"),
                benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    packed = corpus_pipeline.run(spark, at)
    assert {x.doc_id for x in packed.collect()} == {i for i, _ in got}
    assert packed.filter("doc_id in (40, 41)").agg({"length": "min"}).first()[0] > 100


def test_pipeline_on_empty_tables(spark, docs_of, folder):
    at = folder(documents=docs_of([]), labels=spark.createDataFrame([], "doc_id bigint, toxic int"),
                benchmark=spark.createDataFrame([], "item_id bigint, text string"))
    assert corpus_pipeline.run(spark, at).count() == 0
