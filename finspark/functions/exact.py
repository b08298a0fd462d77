"""Exact sums of doubles as plain SQL aggregates (R-44, R-45, R-51, R-52).

A double is cut into digits of ``WIDTH`` bits at fixed powers of two, each an
exact double expression, and every digit is summed as a ``bigint``: nine
ordinary ``sum`` aggregates, partial on the map side, the same for any order,
partitioning or retry. The sums are carried into one normal form and turned
into a double once. Nothing is collected, so a group may have any size (up to
2^40 rows).

Exact for values below 2^117 in size, from units of 2^-96 on (a value's part
below that is rounded to it); larger values and infinities raise an error, NaN
is missing. For money with four decimals :func:`expr.dsum` is cheaper.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import nan_to_null

WIDTH = 24
#: Powers of 2^WIDTH that the digits stand for.
PLACES = range(-4, 5)
MOST = 2.0 ** 117


def _digit(x: Column, place: int) -> Column:
    """The digit of ``x`` at ``place``, nearest to zero: what rounding to the
    place keeps less what rounding to the next one keeps. Scaling by powers
    of two, ``rint`` and the difference are all exact."""
    here = F.rint(x * F.lit(2.0 ** (-WIDTH * place)))
    if place == PLACES[-1]:
        return here.cast("bigint")
    return (here - F.rint(x * F.lit(2.0 ** (-WIDTH * (place + 1)))) * F.lit(2.0 ** WIDTH)).cast("bigint")


def _carried(sums: Column) -> Column:
    """Digits in [0, 2^WIDTH) from the lowest place on, and what is left over."""
    start = F.struct(F.lit(0).cast("bigint").alias("c"), F.array().cast("array<bigint>").alias("d"))

    def add(s: Column, v: Column) -> Column:
        t = v + s["c"]
        return F.struct(F.shiftright(t, WIDTH).alias("c"), F.array_append(s["d"], t.bitwiseAND(F.lit((1 << WIDTH) - 1))).alias("d"))

    return F.aggregate(sums, start, add, lambda s: F.array_append(s["d"], s["c"]))


def exact_sum(c) -> Column:
    """Sum of a double expression, null without a value."""
    x = nan_to_null(c)
    x = F.when(x.isNull() | (F.abs(x) < F.lit(MOST)), x).otherwise(
        F.raise_error(F.concat(F.lit("value outside the exact range: "), x.cast("string"))).cast("double"))
    sums = F.array(*[F.sum(_digit(x, p)) for p in PLACES])
    up = _carried(sums)
    below = F.element_at(up, -1) < 0
    digits = F.when(below, _carried(F.transform(sums, lambda v: -v))).otherwise(up)
    weights = F.array(*[F.lit(2.0 ** (WIDTH * p)) for p in [*PLACES, PLACES[-1] + 1]])
    size = F.aggregate(F.reverse(F.zip_with(digits, weights, lambda d, w: d.cast("double") * w)), F.lit(0.0), lambda a, v: a + v)
    return F.when(F.count(x) > 0, F.when(below, -size).otherwise(size))


def exact_mean(c) -> Column:
    """Exact sum over the number of values that are not missing."""
    x = nan_to_null(c)
    return F.try_divide(exact_sum(x), F.count(x).cast("double"))
