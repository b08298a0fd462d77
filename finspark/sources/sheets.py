"""Text sheets read row by row into typed rows and rejects (R-01 .. R-03,
R-05, R-08).

A sheet is a folder of delimited text, as exported from a workbook. It is
read once as text: a line with the wrong number of fields, a required field
that is missing, or a text that is no value of its column's type makes the
line a reject, with the line's number fields, the text at fault and the
reason; all other lines become typed rows. Nothing is dropped and nothing
turns null silently. A manifest says, sheet by sheet and file by file, how
many of each there were.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import money_text, percent_text, to_date_safe, to_double_safe
from ..session import materialize
from .files import optional_source

BROKEN = "_broken"


@dataclass(frozen=True)
class Sheet:
    """``columns``: name to type - string, date, int, double, money ('1,234.5')
    or percent ('5%', 'N/A' is missing) - in the order of the fields."""

    name: str
    columns: dict[str, str]
    required: Sequence[str] = ()
    date_format: str | None = None
    header: bool = False
    sep: str = ","
    options: dict[str, str] = field(default_factory=dict)


def _typed(sheet: Sheet, name: str) -> Column:
    kind, c = sheet.columns[name], F.trim(F.col(name))
    if kind == "string":
        return F.nullif(c, F.lit(""))
    if kind == "date":
        return to_date_safe(c, sheet.date_format)
    if kind == "int":
        return c.try_cast("bigint")
    if kind == "double":
        return to_double_safe(c)
    if kind == "money":
        return money_text(c)
    if kind == "percent":
        return percent_text(c)
    raise ValueError(f"{sheet.name}.{name}: unknown type {kind!r}")


def read_sheet(spark: SparkSession, path: str, sheet: Sheet) -> tuple[DataFrame, DataFrame] | None:
    """(rows, rejects) of the sheet stored at ``path``, None where there is
    none (R-08). Rows have the sheet's columns and ``source_file``; rejects
    ``source_file``, ``line`` (the fields as text), ``reason``."""
    if unknown := [c for c in sheet.required if c not in sheet.columns]:
        raise ValueError(f"{sheet.name}: no such columns {unknown}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*sheet.columns, BROKEN]])
    raw = optional_source(spark, path, "csv", text, header=str(sheet.header).lower(), sep=sheet.sep, mode="PERMISSIVE",
                          columnNameOfCorruptRecord=BROKEN, **sheet.options)
    if raw is None:
        return None
    blank = {c: F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in sheet.columns}
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("wrong number of fields"))
    for c, kind in sheet.columns.items():
        if c in sheet.required:
            reason = reason.when(blank[c], F.lit(f"{c}: missing"))
        missing = blank[c] | (F.upper(F.trim(F.col(c))) == "N/A") if kind == "percent" else blank[c]
        reason = reason.when(~missing & _typed(sheet, c).isNull(), F.concat(F.lit(f"{c}: no {kind}: "), F.trim(F.col(c))))
    line = F.coalesce(F.col(BROKEN), F.concat_ws(sheet.sep, *[F.coalesce(F.col(c), F.lit("")) for c in sheet.columns]))
    read = materialize(raw.select(*[_typed(sheet, c).alias(c) for c in sheet.columns],
                                  F.regexp_extract(F.col("_metadata.file_path"), r"[^/]*$", 0).alias("source_file"),
                                  line.alias("line"), reason.alias("reason")), "sheet")
    return (read.filter("reason is null").drop("line", "reason"),
            read.filter("reason is not null").select("source_file", "line", "reason"))


def read_sheets(spark: SparkSession, folder: str, sheets: Sequence[Sheet]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """The sheets of a folder that are there (R-05), by name."""
    found = {s.name: read_sheet(spark, f"{folder.rstrip('/')}/{s.name}", s) for s in sheets}
    return {k: v for k, v in found.items() if v is not None}


def manifest(read: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """sheet, source_file, n_rows, n_rejects."""
    parts = [d.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sheet"), "source_file", F.lit(k).alias("k"), "n")
             for name, pair in read.items() for k, d in zip(("rows", "rejects"), pair)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    n = {k: F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n"))), F.lit(0)) for k in ("rows", "rejects")}
    return out.groupBy("sheet", "source_file").agg(n["rows"].alias("n_rows"), n["rejects"].alias("n_rejects"))
