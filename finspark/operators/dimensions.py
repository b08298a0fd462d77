"""Dimensional ETL (D-01 .. D-08): dimensions with surrogate keys, bridge
tables, facts keyed by looked-up ids, text cleaning, profile pivot and the
peer-statement merge. Dimension lookups are equi-joins; the dimension side
is broadcast only behind the planner's size estimate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import concat_sep, dsum, money_text, percent_text, split_trim, to_double_safe, year_from_text
from ..functions.names import ensure_columns, standardise_columns, standardise_financial_name, standardise_name
from ..session import materialize
from .joins import sized_broadcast
from .references import resolve_names
from .upsert import assign_keys, dedupe, insert_new, upsert


#: The peer catalog's measures and the names that differ.
PEER_MEASURES = ("total_revenue", "cost_of_revenue", "gross_profit", "operating_income", "interest_expense", "net_income",
                 "total_assets", "inventory", "accounts_payable", "long_term_debt")
PEER_RENAMES = {"year": "fiscal_year", "ap": "accounts_payable"}


def distinct_names(sources: Sequence[DataFrame], name_col: str = "name") -> DataFrame:
    """R-46 / R-66: distinct non-null names over several sources (each source
    is a one-column DataFrame)."""
    u = None
    for s in sources:
        s1 = s.select(F.col(s.columns[0]).alias(name_col))
        u = s1 if u is None else u.unionByName(s1)
    return u.filter(F.col(name_col).isNotNull()).distinct()


def load_dimension(sources: Sequence[DataFrame], name_col: str = "name", id_col: str = "id",
                   existing: DataFrame | None = None, attrs: DataFrame | None = None,
                   attr_order: Sequence[str] = ()) -> DataFrame:
    """D-01: ids for the distinct names (existing ids kept, R-13); optional
    attributes joined on the name, later row (by ``attr_order``) wins."""
    dim = assign_keys(distinct_names(sources, name_col), name_col, existing, id_col)
    if attrs is not None:
        a = dedupe(attrs.filter(F.col(name_col).isNotNull()), [name_col], attr_order, "last")
        dim = dim.join(a, name_col, "left")
    return dim


def lookup(df: DataFrame, dim: DataFrame, name_col: str, name_key: str, id_col: str, out: str,
           keep_unmatched: bool = False) -> DataFrame:
    """R-34 / R-35: replace a name column by its dimension id."""
    d = sized_broadcast(dim.select(F.col(name_key).alias(name_col), F.col(id_col).alias(out)))
    return df.join(d, name_col, "left" if keep_unmatched else "inner")


def unmatched(df: DataFrame, dim: DataFrame, name_col: str, name_key: str) -> DataFrame:
    """R-36: rows whose reference has no dimension entry (left anti join).
    The reference side is de-duplicated first (a partial aggregate), so a
    key repeated in a third of a fact table cannot skew the join."""
    return df.join(dim.select(F.col(name_key).alias(name_col)).distinct(), name_col, "left_anti")


def load_bridge(src: DataFrame, left_name: str, list_col: str, left_dim: DataFrame,
                right_dim: DataFrame, name_key: str = "name", id_col: str = "id",
                left_out: str = "left_id", right_out: str = "right_id", sep: str = ";"):
    """D-02: split a ``sep``-separated list, trim, map both sides to ids,
    ignore duplicate pairs. Returns ``(bridge, unknown_names)``."""
    pairs = src.select(F.col(left_name), F.explode(split_trim(list_col, sep)).alias("_item"))
    known = lookup(pairs, left_dim, left_name, name_key, id_col, left_out)
    unknown = unmatched(known, right_dim, "_item", name_key).select(
        left_name, F.col("_item").alias(f"unknown_{list_col}")).distinct()
    bridge = lookup(known, right_dim, "_item", name_key, id_col, right_out)
    return bridge.select(left_out, right_out).distinct(), unknown


def load_fact(src: DataFrame, fks: Mapping[str, tuple[DataFrame, str]], required: Sequence[str] = (),
              keys: Sequence[str] | None = None, order_cols: Sequence[str] = (),
              target: DataFrame | None = None, mode: str = "upsert",
              keep_unmatched: Sequence[str] = (), name_key: str = "name", id_col: str = "id",
              hot_names: Sequence[str] = ()) -> DataFrame:
    """D-03: map each FK name column to its id (``fks = {name_col: (dim, out)}``),
    drop rows missing a required FK or field, then write by ``mode``:
    'upsert' (last wins on ``keys``), 'insert' (first wins) or 'append'.
    Columns of ``hot_names`` have large dimensions and names that hold many
    rows (:func:`references.resolve_names`; the rows are stored before each)."""
    df = src
    for name_col, (dim, out) in fks.items():
        keep = name_col in keep_unmatched
        if name_col in hot_names:
            df = resolve_names(materialize(df, "fact"), dim, name_col, out, name_key, id_col, keep)
        else:
            df = lookup(df, dim, name_col, name_key, id_col, out, keep_unmatched=keep)
        df = df.drop(name_col)
    if required:
        df = df.na.drop(subset=list(required))
    if mode == "append":
        return df if target is None else target.unionByName(df, allowMissingColumns=True)
    if mode == "upsert":
        return upsert(target, df, keys, order_cols)
    if mode == "insert":
        base = target if target is not None else df.where(F.lit(False))
        return insert_new(base, df, keys, order_cols)
    raise ValueError(mode)


def profile_pivot(long: DataFrame, entity: str, attr: str, value: str, attrs: Sequence[str],
                  agg: str = "one", int_attrs: Sequence[str] = ()) -> DataFrame:
    """D-04 / R-48: attribute/value rows -> one row per entity with one column
    per listed attribute (listing them avoids a distinct pass). Rows without
    an entity name are dropped; ``int_attrs`` are cast to int."""
    g = long.filter(F.col(entity).isNotNull()).groupBy(entity).pivot(attr, list(attrs))
    if agg == "one":
        out = g.agg(F.min(value))  # one value a pair; of repeated ones the least, in any order
    elif agg == "sum":
        out = g.agg(dsum(value))
    else:
        raise ValueError(agg)
    for a in int_attrs:
        out = out.withColumn(a, F.col(a).try_cast("double").cast("int"))
    return out


def parse_goals(df: DataFrame, goal_col: str = "goal", text_col: str = "description") -> DataFrame:
    """D-05: description = goal + ' - ' + text (null-safe), target year from
    'by YYYY' in the text."""
    return df.withColumns({
        "goal_description": concat_sep(" - ", goal_col, text_col),
        "target_year": year_from_text(text_col),
    })


def clean_campaigns(df: DataFrame, uplift_col: str = "sales_uplift_est",
                    duration_col: str = "duration_months") -> DataFrame:
    """D-06: percent text -> fraction; duration -> nullable int."""
    return df.withColumns({
        uplift_col: percent_text(uplift_col),
        duration_col: F.col(duration_col).try_cast("double").cast("int"),
    })


def load_statement(src: DataFrame, target_columns: Sequence[str], key: str = "statement_date",
                   target: DataFrame | None = None, order_cols: Sequence[str] = (),
                   keys: Sequence[str] = ()) -> DataFrame:
    """D-07: standardise names, the first column that is no entity key becomes
    ``key`` (unless a column has that name), keep catalog columns only (plus
    ``keys`` and ``order_cols``), upsert on (``keys``, date).
    ``keys``/``order_cols`` are given in standardised form. A date that does
    not parse, or is missing, fails the load: no row is left out silently."""
    df = standardise_columns(src)
    dcol = key if key in df.columns else next(c for c in df.columns if c not in keys)
    date = F.col(dcol).try_cast("date")
    bad = F.concat(F.lit(f"{dcol}: not a date: "), F.coalesce(F.col(dcol).cast("string"), F.lit("null")))
    df = df.withColumn(key, F.coalesce(date, F.raise_error(bad).cast("date")))
    if dcol != key:
        df = df.drop(dcol)
    wanted = set(target_columns) | {key} | set(keys) | set(order_cols)
    df = df.select(*[c for c in df.columns if c in wanted])
    return upsert(target, df, [*keys, key], order_cols)


def merge_peer_financials(income_year: DataFrame, balance_year: DataFrame,
                          keys: Sequence[str] = ("competitor_id",), year: str = "fiscal_year",
                          money_cols: Sequence[str] = (), target: DataFrame | None = None) -> DataFrame:
    """D-08: year-grain income and balance of each peer, full outer joined on
    (peer, year), null years dropped, money text cleaned, upserted on
    (peer, year)."""
    keys = list(keys)
    inc = standardise_columns(income_year, standardise_name)
    bal = standardise_columns(balance_year, standardise_name)
    m = inc.join(bal, keys + [year], "full_outer").filter(F.col(year).isNotNull())
    if money_cols:
        m = m.withColumns({c: money_text(c) for c in money_cols if c in m.columns})
    return upsert(target, m, keys + [year])


def peer_measures(raw: DataFrame, company: str = "company", keep: Sequence[str] = ()) -> DataFrame:
    """One statement of text columns, as delivered: financial names (R-17),
    ``year`` -> ``fiscal_year`` and ``ap`` -> ``accounts_payable``, the
    catalog's measures as numbers, other columns but those to ``keep``
    (standardised names) dropped. A year that is no whole number is null; a statement without a year column is an error."""
    df = standardise_columns(raw, standardise_financial_name)
    df = df.withColumnsRenamed({k: v for k, v in PEER_RENAMES.items() if k in df.columns and v not in df.columns})
    if "fiscal_year" not in df.columns:
        raise ValueError("no year column in the statement")
    year = to_double_safe("fiscal_year")
    own = [c for c in PEER_MEASURES if c in df.columns]
    return df.select(company, F.when(year == F.floor(year), year.cast("int")).alias("fiscal_year"),
                     *[money_text(c).alias(c) for c in own], *keep)


def load_peers(income: DataFrame, balance: DataFrame, companies: DataFrame, company: str = "company",
               target: DataFrame | None = None, name_key: str = "name", id_col: str = "id",
               order_cols: Sequence[str] = ()) -> DataFrame:
    """D-08 from raw text: both statements through :func:`peer_measures`, full
    outer join on (company, year), null years dropped, company ids looked up
    (``companies``, kept up by :func:`load_dimension`, or as
    :func:`stored_ids.register` returns them after it was given the
    statements' names), all ten measures present, upserted on
    (competitor_id, fiscal_year). Of rows for one company and year in a
    statement the last by ``order_cols`` (standardised names) counts."""
    keys = [company, "fiscal_year"]
    sides = [dedupe(peer_measures(s, company, order_cols).na.drop(subset=["fiscal_year"]), keys, order_cols).drop(*order_cols)
             for s in (income, balance)]
    both = sides[0].join(sides[1], keys, "full_outer")
    both = lookup(both, companies, company, name_key, id_col, "competitor_id").drop(company)
    both = ensure_columns(both, {c: "double" for c in PEER_MEASURES})
    return upsert(target, both.select("competitor_id", "fiscal_year", *PEER_MEASURES), ["competitor_id", "fiscal_year"])


__all__ = ["load_peers", "peer_measures", "distinct_names", "load_dimension", "lookup", "unmatched", "load_bridge", "load_fact",
           "profile_pivot", "parse_goals", "clean_campaigns", "load_statement",
           "merge_peer_financials", "insert_new"]
