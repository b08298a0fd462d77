"""Keyed upserts with keys that change partition, and runs that die."""

import random

import pytest

from finspark.operators import moves
from finspark.operators.upsert import upsert

COLS = "k int, part string, v double, note string"


def _table(spark, path):
    return {r["k"]: (r["part"], r["v"], r["note"]) for r in spark.read.parquet(path).collect()}


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, f"p{i % 4}", float(i), "old") for i in range(20)] + [(100, None, 1.0, "old"), (200, "a/b =c%", 2.0, "old"), (300, "single", 3.0, "old")]
    moves.upsert_moving(_df(spark, rows), path, ["k"], ["part"])
    return path, {k: (p, v, n) for k, p, v, n in rows}


def test_moved_keys_are_in_one_place(spark, stored):
    path, want = stored
    assert _table(spark, path) == want
    batch = [(1, "p3", 11.0, "new"), (2, "p2", 12.0, "new"), (3, None, 13.0, "new"), (50, "fresh", 50.0, "new"),
             (100, "p0", 14.0, "new"), (200, "p0", 15.0, "new"), (300, "a/b =c%", 16.0, "new")]
    moves.upsert_moving(_df(spark, batch), path, ["k"], ["part"])
    want |= {k: (p, v, n) for k, p, v, n in batch}
    assert spark.read.parquet(path).count() == len(want) and _table(spark, path) == want
    moves.upsert_moving(_df(spark, batch), path, ["k"], ["part"])  # the same batch again
    assert spark.read.parquet(path).count() == len(want) and _table(spark, path) == want
    import os
    assert "part=single" not in os.listdir(path)  # nothing is left in it


def test_partitions_of_odd_names_are_emptied(spark, stored):
    path, want = stored
    moves.upsert_moving(_df(spark, [(200, "x y*", 1.0, "n"), (100, "p0", 1.0, "n")]), path, ["k"], ["part"])
    want |= {200: ("x y*", 1.0, "n"), 100: ("p0", 1.0, "n")}
    assert spark.read.parquet(path).count() == len(want) and _table(spark, path) == want
    moves.upsert_moving(_df(spark, [(200, None, 2.0, "n"), (100, None, 2.0, "n")]), path, ["k"], ["part"])
    want |= {200: (None, 2.0, "n"), 100: (None, 2.0, "n")}
    assert spark.read.parquet(path).count() == len(want) and _table(spark, path) == want


def test_last_of_a_batch_wins_and_lacking_columns_stay(spark, stored):
    path, want = stored
    batch = spark.createDataFrame([(1, "p0", 5.0, 1), (1, "p9", 6.0, 2), (2, "p2", None, 1)], "k int, part string, v double, seq int")
    target_cols = batch.select("k", "part", "v")
    assert target_cols.columns == ["k", "part", "v"]
    moves.upsert_moving(batch.withColumnRenamed("seq", "note").selectExpr("k", "part", "v", "cast(note as string) note"), path, ["k"], ["part"],
                        ["note"])
    want |= {1: ("p9", 6.0, "2"), 2: ("p2", None, "1")}
    assert _table(spark, path) == want
    moves.upsert_moving(spark.createDataFrame([(4, "p1", 44.0)], "k int, part string, v double"), path, ["k"], ["part"])
    want[4] = ("p1", 44.0, "old")
    assert _table(spark, path) == want


@pytest.mark.parametrize("die_at", [1, 2, 4, "emptying", "before"])
def test_a_run_that_dies_is_finished_by_the_next(spark, stored, monkeypatch, die_at):
    path, before = stored
    batch = [(i, f"p{(i + 1) % 4}", 7.0, "new") for i in range(0, 20, 3)] + [(300, "p1", 7.0, "new")]
    after = before | {k: (p, v, n) for k, p, v, n in batch}
    calls = {"n": 0}
    replace, commit = moves._replace, moves._commit

    def dies(fs, kind, staged, live):
        calls["n"] += 1
        if calls["n"] == die_at:
            fs.delete(kind(live), True)  # as if between the two steps of a replacement
            raise RuntimeError("lost")
        replace(fs, kind, staged, live)
        if die_at == "emptying" and calls["n"] == 4:
            raise RuntimeError("lost")

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(moves, "_replace", dies)
    if die_at == "before":
        monkeypatch.setattr(moves, "_commit", lost)
    with pytest.raises(RuntimeError):
        moves.upsert_moving(_df(spark, batch), path, ["k"], ["part"])
    monkeypatch.setattr(moves, "_replace", replace)
    monkeypatch.setattr(moves, "_commit", commit)
    assert moves.finish_pending(spark, path) is (die_at != "before")
    assert not moves.finish_pending(spark, path)
    got = spark.read.parquet(path)
    assert got.count() == len(after) and _table(spark, path) == (before if die_at == "before" else after)


def test_random_batches_equal_the_plain_upsert(spark, stored):
    path, _ = stored
    r = random.Random(4)
    for step in range(3):
        rows = [(r.randint(0, 30), r.choice(["p0", "p1", "q", None]), float(step), f"{step}-{i}") for i in range(8)]
        batch = _df(spark, rows)
        plain = {x["k"]: (x["part"], x["v"], x["note"])
                 for x in upsert(spark.read.parquet(path).select("k", "part", "v", "note"), batch, ["k"], ["note"]).collect()}
        moves.upsert_moving(batch, path, ["k"], ["part"], ["note"])
        assert _table(spark, path) == plain and spark.read.parquet(path).count() == len(plain)


def test_partition_by_keys_is_refused(spark, tmp_path):
    for parts in ([], ["k"]):
        with pytest.raises(ValueError):
            moves.upsert_moving(_df(spark, []), str(tmp_path / "t"), ["k"], parts)
