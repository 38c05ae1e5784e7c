"""Numeric column expressions: parsing, rounding and tolerance tests."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast also reads Java forms such as `1.5d` or `0x1p3`, so text is matched before it is cast.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"^[+-]?(inf|infinity)$"
RTOL, ATOL = 1e-5, 1e-8


def parse_number(text: Column) -> Column:
    """Plain decimal text to double; anything unreadable becomes null."""
    trimmed = F.trim(text)
    lowered = F.lower(trimmed)
    infinite = F.when(trimmed.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double")).when(
        lowered.rlike(INFINITY_PATTERN), infinite
    )


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def half_even(value: Column, digits: int) -> Column:
    """Banker's rounding on the scaled double."""
    scale = float(10**digits)
    return F.rint(value * scale) / F.lit(scale)


def row_sum(columns: list[Column]) -> Column:
    """Horizontal sum with null as 0."""
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns])


def is_close(a: Column, b: Column, rtol: float = RTOL, atol: float = ATOL) -> Column:
    """|a-b| <= atol + rtol*|b|; false when either is null."""
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def vectors_close(a: Column, b: Column) -> Column:
    """Element-wise is_close over two arrays, where null matches null."""
    return F.forall(
        F.zip_with(a, b, lambda x, y: (x.isNull() & y.isNull()) | is_close(x, y)),
        lambda same: same,
    )


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
