"""Text sheets into typed rows and rejects."""

import datetime as dt

import pytest

from finspark.sources import sheets as sh

COLS = {"k": "int", "day": "date", "v": "double", "m": "money", "p": "percent", "t": "string"}
SHEET = sh.Sheet("s", COLS, required=("k", "day"), header=True)
HEAD = "k,day,v,m,p,t\n"


def _put(tmp_path, **files):
    folder = tmp_path / "s"
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, "utf-8")
    return str(folder)


def test_rows_and_rejects_add_up(spark, tmp_path):
    path = _put(tmp_path, a=HEAD + '1,2024-01-31,1.5,"1,234.5",5%,x\n2,2024-02-30,1,1,1%,x\n,2024-01-01,1,1,1%,x\n3,2024-01-01,abc,,N/A,\n',
                b=HEAD + "4,2024-01-01\n5,2024-01-01,NaN,,,é ü\n6, ,1,1,1,\n7,2024-01-01,1,1,1,x,y,z\n8,2024-03-01,,junk,,\n9.5,2024-03-01,,,,\n")
    rows, rejects = sh.read_sheet(spark, path, SHEET)
    got = {r["k"]: r for r in rows.collect()}
    assert set(got) == {1}
    assert tuple(got[1])[:6] == (1, dt.date(2024, 1, 31), 1.5, 1234.5, 0.05, "x") and got[1]["source_file"] == "a.csv"
    why = sorted((r["source_file"], r["reason"]) for r in rejects.collect())
    assert why == [("a.csv", "day: no date: 2024-02-30"), ("a.csv", "k: missing"), ("a.csv", "v: no double: abc"),
                   ("b.csv", "day: missing"), ("b.csv", "k: no int: 9.5"), ("b.csv", "m: no money: junk"), ("b.csv", "v: no double: NaN"),
                   ("b.csv", "wrong number of fields"), ("b.csv", "wrong number of fields")]
    lines = {r["line"] for r in rejects.collect()}
    assert "4,2024-01-01" in lines and "7,2024-01-01,1,1,1,x,y,z" in lines
    m = {tuple(r) for r in sh.manifest({"s": (rows, rejects)}).collect()}
    assert m == {("s", "a.csv", 1, 3), ("s", "b.csv", 0, 6)}


def test_absent_and_empty_sheets(spark, tmp_path):
    assert sh.read_sheet(spark, str(tmp_path / "none"), SHEET) is None
    path = _put(tmp_path, a=HEAD)
    rows, rejects = sh.read_sheet(spark, path, SHEET)
    assert rows.count() == rejects.count() == 0 and rows.columns == [*COLS, "source_file"]
    both = sh.read_sheets(spark, str(tmp_path), [SHEET, sh.Sheet("other", {"a": "int"})])
    assert list(both) == ["s"]


def test_wrong_descriptions_are_refused(spark, tmp_path):
    path = _put(tmp_path, a=HEAD)
    for bad in (sh.Sheet("s", {"k": "number"}), sh.Sheet("s", {"k": "int"}, required=("z",))):
        with pytest.raises(ValueError):
            sh.read_sheet(spark, path, bad)
