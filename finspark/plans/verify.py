"""Compare a Spark result with its DuckDB oracle: row count, column names
and an order-insensitive hash of the values (doubles compared by repr)."""

from __future__ import annotations

import hashlib

import pandas as pd

from ..sources.fixtures import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            nn = s.dropna()
            fmt = "%Y-%m-%d" if (nn.dt.normalize() == nn).all() else "%Y-%m-%d %H:%M:%S"
            df[c] = s.dt.strftime(fmt).where(s.notna(), None)
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else
                          (repr(float(v)) if isinstance(v, float) else str(v)))
    return df


def value_hash(df: pd.DataFrame) -> str:
    rows = sorted("|".join("∅" if v is None else v for v in r) for r in df.itertuples(index=False))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return False, f"columns spark={sorted(spark_pdf.columns)} oracle={sorted(oracle_pdf.columns)}"
    a, b = normalise(spark_pdf), normalise(oracle_pdf)
    if len(a) != len(b):
        return False, f"rows spark={len(a)} oracle={len(b)}"
    if value_hash(a) != value_hash(b):
        sa = set(map(tuple, a.itertuples(index=False)))
        sb = set(map(tuple, b.itertuples(index=False)))
        return False, f"values differ: spark-only {list(sa - sb)[:2]} oracle-only {list(sb - sa)[:2]}"
    return True, f"{len(a)} rows"
