"""Ratios, means and unit changes.

Money is BIGINT in thousands, so sums are exact and cheap. Means add up whole steps
(tenths, say) and divide once, so a result does not depend on the order in which
partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwide.functions.text import col


def real(value: str | Column) -> Column:
    return col(value).cast("double")


def ratio(top: str | Column, bottom: str | Column, scale: float = 1.0) -> Column:
    """``top * scale / bottom`` as double; null when the bottom is zero or null.

    Whole amounts are scaled before the only division, so a share that is exactly
    on a threshold compares as equal to it.
    """
    return real(top) * F.lit(float(scale)) / F.nullif(real(bottom), F.lit(0.0))


def percent(top: str | Column, bottom: str | Column, places: int = 1) -> Column:
    return F.round(ratio(top, bottom, 100.0), places)


def exact_mean(value: str | Column, scale: int = 1) -> Column:
    """Mean of values held to ``scale`` decimals: whole steps are summed, then divided once.

    Steps of one or two decimals sum as BIGINT; finer ones as a wide decimal, since
    billions of rows could overflow.
    """
    value = col(value)
    steps = F.floor(value * F.lit(10.0**scale) + 0.5)
    if scale > 2:
        steps = steps.cast("decimal(20,0)")
    rows = F.count(value).cast("double") * F.lit(10.0**scale)
    return F.sum(steps).cast("double") / F.nullif(rows, F.lit(0.0))


def rounded_mean(value: str | Column, places: int = 1, scale: int = 1) -> Column:
    return F.round(exact_mean(value, scale), places)


def in_units(value: str | Column, unit: float) -> Column:
    """Thousands to millions (1e3) or billions (1e6)."""
    return real(value) / F.lit(float(unit))


MILLIONS = 1e3
BILLIONS = 1e6


def half_even(value: str | Column, places: int) -> Column:
    return F.bround(col(value), places)


def truncate_to_integer(value: str | Column) -> Column:
    """Text or float to BIGINT, dropping the fraction; unreadable values become 0."""
    number = col(value).try_cast("double")
    return F.coalesce(F.when(F.isnan(number), None).otherwise(number).try_cast("bigint"), F.lit(0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_if(condition: Column, value: str | Column) -> Column:
    return F.sum(F.when(condition, col(value)))


def blank_minus(left: Column, right: Column) -> Column:
    """Difference in which one missing side counts as zero; null when both are missing."""
    both_missing = left.isNull() & right.isNull()
    return F.when(~both_missing, F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0)))
