"""Statements loaded into a stored table whose schema is the catalogue
(R-14, D-07).

The target's columns and types are read from the stored table. A delivered
sheet is conformed to them: names standardised, every known column cast, rows
with a value that its column's type can't hold set aside with the reason,
columns that the table lacks dropped or, if wanted, added to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import find_date_column, standardise_columns
from ..sources.files import optional_source
from .upsert import upsert_into_table


def _cast(c: Column, kind: T.DataType) -> Column:
    """The value as the type, null where it isn't one; thousands marks in
    numbers and blanks around values are no fault, an empty text is null."""
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    if isinstance(kind, T.NumericType):
        text = F.regexp_replace(text, ",", "")
    return text.try_cast(kind)


def conform(src: DataFrame, schema: T.StructType, key: str, keys: Sequence[str] = (), add_columns: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a delivered sheet. ``rows`` have the schema's
    columns in its order, null where the sheet has no such column, and with
    ``add_columns`` the sheet's others behind. ``rejects`` are (``row``: the
    sheet's row as JSON, ``reason``): the first column in the schema's order
    whose value doesn't fit, or a missing date or entity key. ``key`` is the
    date column; a sheet without it brings it as its date column by name.
    Two of the sheet's columns under one standardised name are an error."""
    df = standardise_columns(src)
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if twice:
        raise ValueError(f"columns with one name: {twice}")
    if key not in df.columns:
        found = find_date_column(df.drop(*[c for c in schema.names if c in df.columns]))
        if found is None:
            raise ValueError(f"no date column for {key}")
        df = df.withColumnRenamed(found, key)
    known = [f for f in schema.fields if f.name in df.columns]
    missing = [c for c in keys if c not in df.columns]
    if missing:
        raise ValueError(f"no columns for the keys {missing}")
    fits = {f.name: _cast(F.col(f"_src.{f.name}"), f.dataType) for f in known}
    reason = F.coalesce(*[F.when(
        F.col(f"_fit.{f.name}").isNull() & (F.trim(F.col(f"_src.{f.name}").cast("string")) != ""),
        F.concat(F.lit(f"{f.name}: no {f.dataType.simpleString()}: "), F.col(f"_src.{f.name}").cast("string"))) for f in known],
        *[F.when(F.col(f"_fit.{c}").isNull(), F.lit(f"{c}: missing")) for c in (key, *keys)])
    x = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_src"))
    x = x.withColumn("_fit", F.struct(*[v.alias(c) for c, v in fits.items()])).withColumn("_reason", reason)
    new = [c for c in df.columns if c not in schema.names] if add_columns else []
    rows = x.filter(F.col("_reason").isNull()).select(
        *[(F.col(f"_fit.{f.name}") if f.name in fits else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields],
        *[F.col(f"_src.{c}").alias(c) for c in new])
    rejects = x.filter(F.col("_reason").isNotNull()).select(F.to_json("_src").alias("row"), F.col("_reason").alias("reason"))
    return rows, rejects


def load_into_catalogue(src: DataFrame, path: str, key: str = "statement_date", keys: Sequence[str] = (), order_cols: Sequence[str] = (),
                        add_columns: bool = False) -> DataFrame:
    """D-07 against a stored table: the sheet conformed to the table's schema
    and upserted on (``keys``, ``key``), the last row by ``order_cols`` (of
    the table's columns) winning; a table column that the sheet lacks keeps
    its value. Returns the rejects. A sheet that is loaded twice changes
    nothing the second time. The table must exist: it is the catalogue."""
    table = optional_source(src.sparkSession, path)
    if table is None:
        raise FileNotFoundError(f"no stored table {path}")
    rows, rejects = conform(src, table.schema, key, keys, add_columns)
    delivered = set(standardise_columns(src).columns) | {key}
    own = [c for c in rows.columns if c in delivered]
    upsert_into_table(rows.select(*own), path, [*keys, key], order_cols)
    return rejects
