"""Scans and sinks (R-01 .. R-09).

Every reader takes an explicit schema (no inference pass over 100 TB) and
returns a lazy DataFrame, so projections and filters written later reach
the file scan (``PushedFilters`` / ``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import nan_to_null, to_double_safe


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """R-01/R-02/R-04: typed scan of csv / parquet / json (header on for csv)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true").option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def read_csv_as_text(spark: SparkSession, path: str, columns: Iterable[str],
                     numeric: Iterable[str] = ()) -> DataFrame:
    """R-03: read every column as string, then coerce the listed ones."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = read_table(spark, path, "csv", schema)
    num = set(numeric)
    return df.select(*[to_double_safe(c).alias(c) if c in num else F.col(c) for c in df.columns])


def load_sheet(spark: SparkSession, folder: str, sheet: str, schema=None,
               fmt: str = "csv") -> DataFrame:
    """R-05: one folder per workbook sheet (the workbook itself is exported)."""
    return read_table(spark, f"{folder.rstrip('/')}/{sheet}", fmt, schema)


def pivot_series(long: DataFrame, ids: Mapping[str, str], id_col: str = "series_id",
                 ds_col: str = "ds", value_col: str = "value") -> DataFrame:
    """R-06: long (series_id, ds, value) -> wide, ids renamed to names. The
    pivot values are listed so Spark does not run a distinct job first. Of
    repeated values the least is taken."""
    wide = (long.filter(F.col(id_col).isin(list(ids)))
            .groupBy(ds_col).pivot(id_col, list(ids)).agg(F.min(value_col)))
    return wide.withColumnsRenamed(dict(ids))


def transpose_statement(long: DataFrame, items: Iterable[str], key_cols=("ticker",),
                        item_col: str = "item", date_col: str = "date",
                        value_col: str = "value") -> DataFrame:
    """R-07: statement stored item x date -> one row per (key, year); of
    several values for an item and year the least."""
    items = list(items)
    return (long.withColumn("fiscal_year", F.year(date_col))
            .groupBy(*key_cols, "fiscal_year").pivot(item_col, items)
            .agg(F.min(value_col)))


def optional_source(spark: SparkSession, path: str, fmt: str = "parquet",
                    schema: T.StructType | str | None = None, **options) -> DataFrame | None:
    """R-08: an input that may be absent. Returns ``None`` when the path does
    not exist (a metadata check, no data pass); the consumer then applies its
    fallback constants (e.g. ``history.calibrate`` / ``synthetic_history``)."""
    try:
        df = read_table(spark, path, fmt, schema, **options)
        df.schema  # noqa: B018 - resolves the path now
        return df
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def clean_numeric(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """G1: NaN -> NULL on the listed (default: all floating) columns."""
    cs = {c for c, t in df.dtypes if t in ("double", "float")} if cols is None else set(cols)
    return df.select(*[nan_to_null(c).alias(c) if c in cs else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] = (), mode: str = "overwrite",
                sort_within: Iterable[str] = ()) -> None:
    """R-09: one sink per stage. Partitioned overwrite only replaces the
    partitions present in ``df`` (dynamic mode), so re-running one scenario
    does not drop the others. R-62: ordering happens only here, inside each
    output file (``sortWithinPartitions``: no global sort, no extra shuffle)."""
    sw = list(sort_within)
    if sw:
        df = df.sortWithinPartitions(*sw)
    w = df.write.mode(mode).format(fmt)
    pb = list(partition_by)
    if pb:
        w = w.partitionBy(*pb).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)
