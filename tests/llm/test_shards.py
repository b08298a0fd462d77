"""Operators 2, 6 and 8."""

import io
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from finspark.llm import packing, sharding, warc
from finspark.llm.queries import tokenizer_path

PAGES = "page_id bigint, url string, html string, payload string"


def pages(spark):
    rows = [(i, f"http://x/{i}", "<p>é" + str(i % 7) * 50 if i % 3 else None, "z") for i in range(40)]
    return spark.createDataFrame(rows + [(100, None, "", "z"), (101, "a\r\nb", "\r\n\r\n", "z")], PAGES).repartition(4)


@pytest.mark.parametrize("least", [0, 60])
def test_warc_round_trip(spark, least):
    df = pages(spark)
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(df, least, archive_bytes=2000)).collect()}
    html = {r.page_id: (r.html or "").encode() for r in df.collect()}
    assert set(got) == set(html)
    for i, b in html.items():
        first = min(k for k, x in html.items() if x == b) if len(b) >= least else i
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), warc.digest(b))
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if first == i else ("revisit", first))
        assert got[i].payload is None if first != i else bytes(got[i].payload) == b


@pytest.mark.parametrize("zip64", [False, True])
def test_archive_is_a_zip_file_and_back(zip64):
    records = [(k, warc.record(k, "u", b"x" * k, warc.digest(b"x" * k), None)) for k in range(5)]
    raw = warc.archive(records, zip64)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
        assert all(x.compress_type == zipfile.ZIP_STORED for x in z.infolist())
    asked = []

    def read(a, n):
        asked.append(n)
        return raw[a:a + n]

    got = list(warc.records(read, len(raw)))
    assert [(r["page_id"], r["payload"]) for r in got] == [(k, b"x" * k) for k in range(5)]
    assert sorted(asked)[-len(records):] and max(len(m) for _, m in records) in asked  # ranges, not the whole


def test_foreign_zip_with_comment_and_deflated_member():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a/b.txt", "stored é")
        z.writestr("c.txt", "deflated", zipfile.ZIP_DEFLATED)
        z.comment = b"x PK\x05\x06 y"
    raw = buf.getvalue()
    where = warc.members(lambda a, n: raw[a:a + n], len(raw))
    assert list(where) == ["a/b.txt"]
    a, n = where["a/b.txt"]
    assert raw[a:a + n].decode() == "stored é"
    with pytest.raises(ValueError):
        warc.members(lambda a, n: b"no"[a:a + n], 2)


def test_pages_without_an_id(spark):
    df = spark.createDataFrame([(None, "u", "p", ""), (4, "u", "p", ""), (9, "u", "p", "")], PAGES)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(df)).collect())
    assert got == [(0, "response", None), (4, "response", None), (9, "revisit", 4)]


def test_archive_files_by_spark(spark, tmp_path):
    (tmp_path / "one.wacz").write_bytes(warc.archive([(1, warc.record(1, "u", b"p", warc.digest(b"p"), None))]))
    got = warc.read_archives(warc.archives_in(spark, str(tmp_path))).collect()
    assert [(r.page_id, bytes(r.payload)) for r in got] == [(1, b"p")]


def test_warc_empty_table(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], PAGES))).count() == 0


def test_interleaving(docs_of):
    rows = [(i, f"t{i}" if i % 9 else None, "hot" if i % 3 == 0 else ["a", "b", None][i % 3]) for i in range(700)]
    rows += [(5, "t5", "a")] * 2 + [(6, "", "c")]
    rows += [(1 << 60, None, None)]
    got = sharding.interleave(docs_of(rows, 5), 16, seed=3).collect()
    assert len(got) == len(rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    for source, n in Counter(r.source for r in got).items():  # the mixture, in every shard
        own = Counter(r.shard for r in got if r.source == source)
        assert all(abs(own[s] - n / 16) < 4 for s in sizes), source
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(b) + 16, zlib.crc32(b)) for i, b in texts)
    again = sharding.interleave(docs_of(rows, 2), 16, seed=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharding.interleave(docs_of([]), 16).count() == 0
    assert sorted((r.shard, r.slot) for r in sharding.interleave(docs_of(rows[:3]), 16).collect()) == [(0, 0), (5, 0), (10, 0)]


def test_shards_written_with_their_texts(spark, docs_of, tmp_path):
    rows = [(i, f"t{i}" if i % 9 else None, "hot" if i % 3 == 0 else "ab"[i % 2]) for i in range(500)] + [(5, "t5", "b")] * 3 + [(None, "", None)]
    docs = docs_of(rows, 5)
    path = str(tmp_path / "shards")
    for _ in range(2):  # a repeated run replaces the files
        sharding.write_shards(docs, path, 7, seed=3, files=12)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*docs.columns, "shard", "slot"}
    got = back.select("doc_id", "text", "source", "shard", "slot").collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in got), key=str) == sorted(rows, key=str)
    placed = sharding.interleave(docs, 7, seed=3).collect()
    assert sorted(str((r.doc_id, r.shard, r.slot)) for r in got) == sorted(str((r.doc_id, r.shard, r.slot)) for r in placed)
    for s in range(7):  # slot order inside the files, over the files by name
        slots = [x for f in sorted((tmp_path / "shards" / f"shard={s}").glob("*.parquet"))
                 for x in pq.read_table(f, partitioning=None).column("slot").to_pylist()]
        assert slots == list(range(len(slots))) and slots
    with pytest.raises(ValueError, match="shard"):
        sharding.write_shards(docs.withColumnRenamed("lang", "Shard"), path, 7)


def check_packing(got, size):
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for a, n in sorted(own):
            assert a == at
            at += n
        assert at <= size
    return bins


def test_packing_ids_and_places(docs_of):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    odd = ["a  b", " x", "x ", "a\n\nb", "\n", "tab\tz", "it's 12 é<|endoftext|>", "a \n b", "wide　x", "Été, ß."]
    rows = [(i, t) for i, t in enumerate(odd)] + [(50, None), (51, ""), (60, "word and more. " * 90), (60, "word and more. " * 90),
                                                   (None, "no id")]
    got = packing.pack(docs_of(rows), tokenizer_path(), size=64, keep_ids=True).collect()
    for i, t in dict(rows[:-1]).items():
        want = tok.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        own = own[::2] if i == 60 else own
        assert [x for r in own for x in np.frombuffer(r.ids, "<u4")] == want
        at = 0
        for k, r in enumerate(own):
            assert (r.start, r.length) == (at, len(r.ids) // 4) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
            assert k == 0 or r.length == 64
            at += r.length
    check_packing(got, 64)
    assert len([r for r in got if r.doc_id is None]) == 1
    assert packing.pack(docs_of([]), tokenizer_path()).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_under_every_capacity(rule):
    lengths = np.random.default_rng(1).integers(1, 100, 2000)
    place, offset = packing.best_fit(lengths, 100, 5, 4000.0, rule, (1.0, 0.5, 0.5))
    for b in np.unique(place):
        own = lengths[place == b]
        assert own.sum() <= 100 and len(own) <= 5 and (len(own) == 1 or (own ** 2).sum() <= 4000 or own.max() ** 2 > 4000)
        order = np.argsort(offset[place == b])
        assert (np.cumsum(own[order]) - own[order] == np.sort(offset[place == b])).all()


def test_best_fit_needs_few_sequences():
    lengths = np.random.default_rng(2).integers(1, 2049, 5000)
    place, _ = packing.best_fit(lengths, 2048, 2048, 2048.0 ** 2, "norm", (1.0, 1e-6, 1e-6))
    assert place.max() + 1 <= -(-lengths.sum() // 2048) * 1.01


def test_packing_attention_limit(docs_of):
    got = packing.pack(docs_of([(1, "a b c d e f g h i j " * 20)]), tokenizer_path(), size=64, attention=20.0 ** 2).collect()
    assert max(r.length for r in got) <= 20
    with pytest.raises(ValueError):
        packing.pack(docs_of([]), tokenizer_path(), rule="first")


def test_fast_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    plain, enc = Tokenizer.from_file(path), packing.Encoder(path)
    assert enc.fast is not None
    r = random.Random(5)
    letters = [chr(i) for i in range(0x250)] + ["’", "…", "“", "–"] + ["a", "b", " ", "  ", "\n", "1", "'s", "'ll", ".", ", "] * 15
    other = ["日本", "Ω", "я", "😀", "<|endoftext|>", "　", " ", " "]
    texts = [chr(i) + s for i in range(0x250) for s in ("", "b", " x", "'s")]
    texts += ["".join(r.choice(letters + (other if k % 3 == 0 else [])) for _ in range(r.randint(0, 40))) for k in range(4000)]
    texts += ["a" * 50_000, " " * 20_000, "x. " * 20_000, "<|endoftext|>a<|endoftext|>", "a\r\n\r\n b"]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t[:50])
    assert enc.encode([None, ""]) == [b"", b""]


def test_files_of_another_kind_go_through_the_tokenizer(tmp_path):
    import json

    spec = json.loads(open(tokenizer_path(), encoding="utf-8").read())
    for change in ({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"normalizer": {"type": "Lowercase"}},
                   {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}},
                   {"model": spec["model"] | {"merges": spec["model"]["merges"][:-1]}}):
        assert packing.fast_encoder(spec | change) is None
    assert packing.fast_encoder(spec) is not None


def test_wanted_pieces_bind_but_cost_no_sequence(docs_of):
    r = random.Random(6)
    rows = [(i, "word " * r.choice([1, 2, 3, 20, 45, 50])) for i in range(300)]
    loose = packing.pack(docs_of(rows), tokenizer_path(), size=64).collect()
    kept = packing.pack(docs_of(rows), tokenizer_path(), size=64, wanted_pieces=6).collect()
    few = lambda got: len({x.sequence_id for x in got})
    check_packing(kept, 64)
    assert few(kept) == few(loose)
    per = {}
    for x in kept:
        per[x.sequence_id] = per.get(x.sequence_id, 0) + 1
    assert max(per.values()) <= 6
    tiny = packing.pack(docs_of([(i, "a") for i in range(100)]), tokenizer_path(), size=64, wanted_pieces=6).collect()
    check_packing(tiny, 64)
    assert few(tiny) == -(-sum(x.length for x in tiny) // 64)  # it gives way
    hot = packing.pack(docs_of([(None, "same text")] * 60), tokenizer_path(), size=64, shard_rows=10).collect()
    assert len(hot) == 60 and len({x.sequence_id >> 32 for x in hot}) > 3  # rows without an id are spread
