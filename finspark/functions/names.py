"""Schema-level helpers (R-14, R-16, R-17, R-18, R-23). They read only
``df.columns`` / ``df.schema`` on the driver: no data pass."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Date-column names tried in this order when discovering the
# period column of a loaded table.
DATE_COLUMN_PRIORITY = ("ds", "statement_date", "balance_date", "flow_date", "date")


def standardise_name(name: str) -> str:
    """R-16: trim, non-word runs -> '_', squeeze, strip '_', lower."""
    s = re.sub(r"\W+", "_", str(name).strip())
    s = re.sub(r"_+", "_", s).strip("_")
    return s.lower()


def standardise_financial_name(name: str) -> str:
    """R-17: lower, spaces/dashes -> '_', dots removed, squeeze '_'."""
    s = str(name).strip().lower()
    s = re.sub(r"[\s\-]+", "_", s).replace(".", "")
    s = re.sub(r"_+", "_", s)
    return s


def standardise_columns(df: DataFrame, fn=standardise_name) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def find_date_column(df: DataFrame, priority: Sequence[str] = DATE_COLUMN_PRIORITY) -> str | None:
    """R-18: the period column by name priority, then any ``*_date``, then the
    first date/timestamp-typed column, then an unnamed index column."""
    lower = {c.lower(): c for c in df.columns}
    for p in priority:
        if p in lower:
            return lower[p]
    for c in df.columns:
        if c.lower().endswith("_date"):
            return c
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return f.name
    for c in df.columns:
        if c.lower().startswith("unnamed"):
            return c
    return None


def intersect_columns(df: DataFrame, target: Iterable[str], exclude: Iterable[str] = ()) -> DataFrame:
    """R-14: keep columns present in the target catalog, minus auto keys."""
    tgt = set(target) - set(exclude)
    return df.select(*[c for c in df.columns if c in tgt])


def ensure_columns(df: DataFrame, cols: dict[str, str], default=None) -> DataFrame:
    """R-23: add missing required columns as a typed constant (null or 0)."""
    out = df
    for c, typ in cols.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(default).cast(typ))
    return out
