"""Sums of doubles that don't depend on the order of the rows.

A plain sum rounds after every addition, so it differs with the partitioning. Here
each double is cut into ``DIGITS`` whole numbers of about ``WIDTH`` bits (digits of a
fixed-point number whose lowest bit is 2^``LOWEST``), and the digits are summed as
longs, which is exact in any order; the total is put together once, after the
aggregation, from the lowest digit up, within half a unit in the last place (and a trace).

Exact for values of magnitude 2^-32 to 2^83; smaller ones are first rounded to
multiples of 2^-84 (each by itself, so still in any order). With a value of 2^83 or more, an
infinity or a NaN in a group, the group's result is the plain sum. A group takes
2^34 rows (a long's range over a digit's).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, WIDTH, LOWEST = 6, 28, -84
#: Values below this magnitude are cut into digits.
LIMIT = 2.0 ** (LOWEST + DIGITS * WIDTH - 1)


def _digits(x: Column) -> list[Column]:
    """Whole numbers d with x = sum(d[k] * 2^(LOWEST + k * WIDTH)), lowest first.
    All steps are exact: scaling by powers of two, rounding to whole numbers, and
    a difference that is a whole number of at most WIDTH bits."""
    whole = [F.rint(x * F.lit(2.0 ** -(LOWEST + k * WIDTH))) for k in range(DIGITS)]
    parts = [low - F.lit(2.0 ** WIDTH) * high for low, high in zip(whole, whole[1:])]
    return [p.cast("long") for p in [*parts, whole[-1]]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it's used there."""
    return F.transform(F.array(value), body)[0]


def _put_together(sums: Column) -> Column:
    """The double nearest to the value of an array of digits; carries go up first,
    so that all digits but the highest are between 0 and 2^WIDTH."""
    step = (lambda acc, s: F.struct(
        F.shiftright(acc["carry"] + s, WIDTH).alias("carry"),
        (acc["value"] * F.lit(2.0 ** -WIDTH)
         + (acc["carry"] + s).bitwiseAND(F.lit((1 << WIDTH) - 1))).alias("value")))
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("value"))

    def folded(digits: Column) -> Column:
        return F.aggregate(F.slice(digits, 1, DIGITS - 1), start, step, lambda acc: F.struct(
            (acc["carry"] + digits[DIGITS - 1]).alias("top"), acc["value"].alias("rest")))

    def value(part: Column) -> Column:
        return ((part["rest"] * F.lit(2.0 ** -WIDTH) + part["top"])
                * F.lit(2.0 ** (LOWEST + (DIGITS - 1) * WIDTH)))

    # a negative total by its opposite: its digits would cancel against the highest
    return let(folded(sums), lambda part: F.when(
        part["top"] < 0, -let(folded(F.transform(sums, lambda s: -s)), value)).otherwise(value(part)))


def exact_sum(x: Column) -> Column:
    """The sum of a double column, NULLs left out, as an aggregate of built-in
    functions (with partial aggregates before the shuffle); NULL without a value."""
    x = x.cast("double")
    inside = F.abs(x) < F.lit(LIMIT)  # false for NaN
    sums = F.array(*[F.sum(d) for d in _digits(F.when(inside, x))])
    return (F.when(F.count_if(x.isNotNull() & ~inside) > 0, F.sum(x))
            .when(F.count(x) > 0, let(sums, _put_together)))


def exact_parts(x: Column) -> Column:
    """The sum as (high, low): the nearest double and what it leaves, together
    about twice a double's digits. For values within the limits; NULLs count as 0."""
    sums = F.array(*[F.coalesce(F.sum(d), F.lit(0).cast("long")) for d in _digits(x.cast("double"))])
    return let(sums, lambda digits: let(_put_together(digits), lambda high: F.struct(
        high.alias("high"),
        let(F.array(*[digits[k] - d for k, d in enumerate(_digits(high))]), _put_together).alias("low"))))


def square_parts(x: Column) -> tuple[Column, Column]:
    """x * x as (nearest double, exact remainder), by splitting x into halves."""
    c = x * F.lit(134217729.0)  # 2^27 + 1
    head = c - (c - x)
    tail = x - head
    square = x * x
    return square, ((head * head - square) + F.lit(2.0) * head * tail) + tail * tail


def exact_avg(x: Column) -> Column:
    """The mean from the exact sum; NULL without a value."""
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0))
