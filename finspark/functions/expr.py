"""Scalar Column expressions (R-68 .. R-82 and the G1/G4/G9 rules).

All are built-in Spark SQL expressions so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._compat import col_of

# Scale used for exact, order-independent money sums (G9).
MONEY = "decimal(18,4)"
#: Just below 2^63: scaled values must be smaller.
SCALED_LIMIT = 9.2e18


def nan_to_null(c) -> Column:
    """G1 / R-80: pandas treats NaN as missing; Spark orders NaN above all
    numbers. Convert NaN to NULL at the source so coalesce == fillna."""
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def safe_div(num, den) -> Column:
    """G4 / R-78: missing when the denominator is missing or 0."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def scaled(c, digits: int = 4) -> Column:
    """Exact fixed-point form of a money value: ``x`` rounded half away from
    zero to ``digits`` decimals, as a ``bigint`` count of 10^-digits units.

    Money sums use this instead of ``cast(x as decimal)`` (G9): integer sums
    are exact and order-independent like decimals, but stay in codegen'd long
    arithmetic (a double -> decimal cast goes through a string per value).
    NaN is missing (G1). A value whose ``|x| * 10^digits`` does not fit a long
    raises an error: a cast would saturate without a word."""
    c = nan_to_null(c)
    f = F.lit(float(10 ** digits))
    fits = F.abs(c) * f < F.lit(SCALED_LIMIT)
    v = F.when(c < 0, -F.floor(-c * f + F.lit(0.5))).otherwise(F.floor(c * f + F.lit(0.5))).cast("bigint")
    return F.when(c.isNull() | fits, v).otherwise(
        F.raise_error(F.concat(F.lit("value outside the exact fixed-point range: "), c.cast("string"))).cast("bigint"))


def unscaled(c, digits: int = 4) -> Column:
    """A scaled ``bigint`` (or a sum of them) back to double."""
    return col_of(c).cast("double") / F.lit(float(10 ** digits))


def money(c) -> Column:
    """Addend for an exact sum as ``decimal(18,4)`` (for decimal arithmetic
    on already-aggregated rows; raw-row sums use :func:`scaled`)."""
    return col_of(c).cast(MONEY)


def dsum(c) -> Column:
    """Exact, order-independent sum of a double expression, returned as double."""
    return unscaled(F.sum(scaled(c)))


def dsum_if(pred: Column, c) -> Column:
    """Exact conditional sum; 0 (not null) when no row matches."""
    return unscaled(F.sum(F.when(pred, scaled(c)).otherwise(F.lit(0).cast("bigint"))))


def dmean(c) -> Column:
    """Mean as exact sum / count of non-null values (G9: never avg(double))."""
    c = nan_to_null(c)
    return F.try_divide(unscaled(F.sum(scaled(c))), F.count(c).cast("double"))


def month_end(c) -> Column:
    """R-70: snap a date/timestamp to its month end (``MonthEnd(0)``)."""
    return F.last_day(col_of(c).cast("date"))


def month_start(c) -> Column:
    return F.trunc(col_of(c).cast("date"), "MM")


def to_date_safe(c, fmt: str | None = None) -> Column:
    """R-68: coercing date parse, bad text -> null."""
    c = col_of(c)
    if fmt:
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("date")
    return c.try_cast("date")


def to_double_safe(c) -> Column:
    """R-71: numeric coercion, bad text and 'NaN' -> null; surrounding blanks
    accepted."""
    return nan_to_null(F.trim(col_of(c).cast("string")).try_cast("double"))


def money_text(c) -> Column:
    """R-72: '1,234.50' -> 1234.5; blank -> null; junk -> null."""
    s = F.trim(F.regexp_replace(col_of(c).cast("string"), ",", ""))
    return nan_to_null(F.nullif(s, F.lit("")).try_cast("double"))


def percent_text(c) -> Column:
    """R-73: '5%' -> 0.05, 'N/A' -> null, junk -> null. A bare number is
    also divided by 100, as in the reference."""
    s = F.trim(col_of(c).cast("string"))
    num = nan_to_null(F.regexp_replace(s, "%", "").try_cast("double"))
    return F.when(F.upper(s) == F.lit("N/A"), F.lit(None).cast("double")).otherwise(num / F.lit(100.0))


def year_from_text(c) -> Column:
    """R-74: target year from text such as 'grow by 2030'."""
    y = F.regexp_extract(col_of(c).cast("string"), r"by\s+(\d{4})", 1)
    return F.nullif(y, F.lit("")).try_cast("int")


def split_trim(c, sep: str = ";") -> Column:
    """R-76: 'A; B ;A' -> ['A', 'B', 'A'] (blank items removed)."""
    parts = F.transform(F.split(col_of(c), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def alnum_only(c) -> Column:
    """R-77: strip every char that is not a letter or digit (Unicode aware)."""
    return F.regexp_replace(col_of(c), r"[^\p{L}\p{N}]", "")


def clean_value_name(c) -> Column:
    """G10: Python-like ``\\W`` (Unicode) when cleaning values, not names."""
    s = F.lower(F.trim(col_of(c)))
    s = F.regexp_replace(s, r"(?U)\W+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def gaussian_noise(seed: int, *key_cols) -> Column:
    """R-82: N(0, 1) from a hash of the row key (Box-Muller). Stable under
    repartitioning and retries, unlike ``randn(seed)``."""
    h1 = F.xxhash64(F.lit(seed), *[col_of(k) for k in key_cols])
    h2 = F.xxhash64(F.lit(seed + 1), *[col_of(k) for k in key_cols])
    two53 = float(2 ** 53)
    u1 = (F.shiftrightunsigned(h1, 11).cast("double") + F.lit(1.0)) / F.lit(two53 + 1.0)
    u2 = F.shiftrightunsigned(h2, 11).cast("double") / F.lit(two53)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def portable_noise(seed: int, *key_cols) -> Column:
    """R-82: near-normal noise of mean 0 and spread 1 that any SQL engine
    draws alike: twelve uniform numbers of 20 bits, taken from the md5 digits
    of the seed and the row's key, summed and centred (all exact in doubles;
    values lie between -6 and 6). Null keys count as ''."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(col_of(k).cast("string"), F.lit("")) for k in key_cols])
    halves = [F.md5(F.concat(F.lit(h), text).cast("binary")) for h in ("a", "b")]
    digits = [F.conv(F.substring(h, 5 * i + 1, 5), 16, 10).cast("double") for h in halves for i in range(6)]
    total = digits[0]
    for d in digits[1:]:
        total = total + d
    return (total + F.lit(6.0)) / F.lit(float(1 << 20)) - F.lit(6.0)


def concat_sep(sep: str, *cols) -> Column:
    """R-75: null-safe concatenation (nulls skipped)."""
    return F.concat_ws(sep, *[col_of(c) for c in cols])
