"""Comparisons with an earlier row or an earlier financial year."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwide.functions import fiscal


def prior_row(value: str, key: str = "org_code", order: str = "financial_year") -> Column:
    """Value of the previous row, whatever year that is. One row per key and year, so groups stay small."""
    return F.lag(value).over(Window.partitionBy(key).orderBy(order))


def prior_year(value: str | Column, keys: Sequence[str], year: str = "financial_year") -> Column:
    """Value of exactly the year before; null when that year is absent.

    A range frame on the start year does it in one pass, without a self join.
    """
    window = Window.partitionBy(*keys).orderBy(fiscal.start_of_label(year)).rangeBetween(-1, -1)
    return F.max(value).over(window)


def year_pair(
    df: DataFrame,
    key: str,
    current: str,
    prior: str,
    keep: Iterable[str],
    compare: Iterable[str],
) -> DataFrame:
    """Rows of ``current`` beside the same key's row of ``prior``; keys missing a year drop out.

    A self join on a unique key written as one aggregate: the input is read once.
    ``keep`` columns come from the current year, ``compare`` columns from both, the
    prior one with suffix ``_prior``.
    """
    now, then = F.col("financial_year") == current, F.col("financial_year") == prior
    compare = list(compare)
    return (
        df.where(F.col("financial_year").isin(current, prior))
        .groupBy(key)
        .agg(
            F.max(F.when(now, F.lit(True))).alias("_now"),
            F.max(F.when(then, F.lit(True))).alias("_then"),
            *(F.max(F.when(now, F.col(c))).alias(c) for c in [*keep, *compare]),
            *(F.max(F.when(then, F.col(c))).alias(c + "_prior") for c in compare),
        )
        .where("_now AND _then")
        .drop("_now", "_then")
    )


def year_to_date(value: str, keys: Sequence[str], period: str) -> Column:
    """Running total within the year; keys must include the year, so a group is at most 12 periods."""
    window = Window.partitionBy(*keys).orderBy(period)
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0))
