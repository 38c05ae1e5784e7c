"""Compositions: groups of percentage columns that should add up to 100."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattsift.functions.numbers import half_even, is_close, row_sum


def sums_to_hundred(columns: list[Column], tolerance: float = 0.1) -> Column:
    """Reporting flag: null counts as 0 and the sum is rounded to 4 decimals first."""
    return F.abs(half_even(row_sum(columns), 4) - 100.0) <= F.lit(tolerance)


def usable_composition(columns: list[Column]) -> Column:
    """Donor test: complete, non-negative, and within 0.1 + 1e-5 * 100 of 100."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & c.isNotNull() & (c >= 0.0)
    return F.coalesce(complete & is_close(row_sum(columns), F.lit(100.0), atol=0.1), F.lit(False))


def rescale_to_hundred(values: Column) -> Column:
    """Array of shares scaled to 100: null as 0, negatives as 0, an empty mix goes to the first share."""
    floored = F.transform(values, lambda x: F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)))
    total = F.aggregate(floored, F.lit(0.0), lambda acc, x: acc + x)
    scaled = F.transform(floored, lambda x: x * (F.lit(100.0) / total))
    first_only = F.transform(floored, lambda x, i: F.when(i == 0, 100.0).otherwise(0.0))
    return F.when(total <= 0, first_only).otherwise(scaled)


def ascending_with_top_last(means: Column) -> Column:
    """Positions of an array in ascending order of value, the first maximum moved to the end.

    Means are compared after rounding to 9 decimals so that the order does not hang on the
    order in which partial sums were merged.
    """
    rounded = F.transform(means, lambda x: F.round(x, 9))
    top = F.array_position(rounded, F.array_max(rounded)).cast("int") - 1
    ordered = F.transform(
        F.array_sort(F.transform(rounded, lambda x, i: F.struct(x.alias("value"), i.alias("pos")))),
        lambda s: s["pos"],
    )
    return F.concat(F.filter(ordered, lambda p: p != top), F.array(top))


def first_open_source(order: Column, shares: Column) -> Column:
    """First position of `order` on which the mix is not already concentrated, else the first position."""
    total = F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)

    def is_open(pos: Column) -> Column:
        current = F.element_at(shares, pos + 1)
        return ~is_close(current, F.lit(100.0)) | ~is_close(total - current, F.lit(0.0))

    return F.coalesce(F.get(F.filter(order, is_open), F.lit(0)), F.get(order, F.lit(0)))


def all_on(position: Column, width: int) -> Column:
    """Array of `width` shares with 100 at `position`."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i == position, 100.0).otherwise(0.0))
