"""Ratios of the home company and its peers in one keyed store (D-20 .. D-22).

The home company's yearly statements come from monthly tables, the peers' as
they were delivered by year; both go through the same ratio table in one
pass. The store has one row per (company, year, ratio).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import ensure_columns
from .ratios import annualise, derive_equity, financial_ratios
from .upsert import dedupe, upsert_into_table

#: Yearly figures that the ratios read, null where a company has none.
FIGURES = ("total_revenue", "cost_of_revenue", "gross_profit", "operating_income", "net_income", "interest_expense",
           "total_assets", "inventory", "accounts_payable", "long_term_debt", "total_equity", "total_liabilities",
           "total_current_assets", "total_current_liabilities", "cash_and_equivalents")
RATIO_KEYS = ("company_name", "fiscal_year", "ratio_name")


def home_statements(income: DataFrame, balance: DataFrame, company: str = "company_name") -> DataFrame:
    """Monthly income (``ds``) and balances (``balance_date``) of the home
    company or companies, by year; a year needs both."""
    return _figures(annualise(income, balance, [company]), company)


def peer_statements(annual: DataFrame, companies: DataFrame, name_key: str = "name", id_col: str = "id",
                    company: str = "company_name") -> DataFrame:
    """Yearly statements keyed by ``competitor_id`` under the peers' names;
    equity from assets and liabilities for a peer that reports none."""
    named = annual.join(companies.select(F.col(id_col).alias("competitor_id"), F.col(name_key).alias(company)), "competitor_id")
    return derive_equity(_figures(named, company), [company])


def _figures(df: DataFrame, company: str) -> DataFrame:
    df = ensure_columns(df, {c: "double" for c in FIGURES})
    return df.select(company, F.col("fiscal_year").cast("int").alias("fiscal_year"), *FIGURES)


def company_ratios(home: DataFrame, peers: DataFrame, company: str = "company_name") -> DataFrame:
    """The 14 ratios of all companies, one row per (company, year, ratio).
    Growth is against the company's own year before in the same source; a
    ratio that home and a peer of the same name both have is the peer's."""
    both = home.withColumn("_side", F.lit(0)).unionByName(peers.withColumn("_side", F.lit(1)))
    long = financial_ratios(both, ["_side", company])
    return dedupe(long, [company, "fiscal_year", "ratio_name"], ["_side"]).select(
        company, "fiscal_year", "ratio_category", "ratio_name", "ratio_value")


def store_ratios(ratios: DataFrame, path: str, keys: Sequence[str] = RATIO_KEYS) -> None:
    """Upserts the ratios into the store, which is partitioned by year: only
    the years at hand are rewritten, and a repeated run changes nothing."""
    upsert_into_table(ratios, path, keys, partition_by=["fiscal_year"])
