"""Long to wide: one scan, one shuffle, any number of columns.

Rows are ``(org_code, financial_year, worksheet_name, sub_code, total_000s, ...)``.
Every output column is a conditional aggregate, so map tasks shrink each
organisation-year to one partial row before anything is shuffled: an
organisation that holds a third of the input still sends one row per map task.
Organisation attributes are joined after the aggregate, on the reduced rows; that
join carries no broadcast hint because organisations grow with the data, so
adaptive execution picks the strategy from the measured size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide.schemas import ORG_ATTRIBUTES, ORG_YEAR, VIEW_KEY

AMOUNT = "total_000s"


def on_sheet(worksheet: str) -> str:
    return f"worksheet_name = '{worksheet}'"


def largest(code: str, column: str, where: str | None = None) -> Column:
    """Largest amount booked under a code (a code can stand under several main codes)."""
    hit = f"sub_code = '{code}'" + (f" AND {where}" if where else "")
    return F.expr(f"max(CASE WHEN {hit} THEN {AMOUNT} END) AS {column}")


def largest_each(
    lines: Mapping[str, str], where: str | None = None, prefix: str = ""
) -> list[Column]:
    return [largest(code, prefix + column, where) for code, column in lines.items()]


def category_total(category: str, column: str, where: str = "true") -> Column:
    """Sum of a category over the rows in ``where``: 0 without a hit, null without any row."""
    hit = f"CASE WHEN analytics_category = '{category}' THEN {AMOUNT} ELSE 0 END"
    return F.expr(f"sum(CASE WHEN {where} THEN {hit} END) AS {column}")


def any_row(where: str, column: str) -> Column:
    return F.expr(f"coalesce(bool_or({where}), false) AS {column}")


def per_org_year(rows: DataFrame, columns: Iterable[Column]) -> DataFrame:
    return rows.groupBy(*ORG_YEAR).agg(*columns)


def with_organisation(org_years: DataFrame, trusts: DataFrame) -> DataFrame:
    """Attach attributes; organisation-years without a known organisation drop out."""
    attributes = trusts.select("org_code", *ORG_ATTRIBUTES)
    rest = [c for c in org_years.columns if c not in VIEW_KEY]
    return org_years.join(attributes, "org_code", "inner").select(*VIEW_KEY, *rest)


def sheet_view(
    fact: DataFrame, trusts: DataFrame, worksheet: str, lines: Mapping[str, str]
) -> DataFrame:
    """One column per line of one schedule."""
    rows = fact.where(on_sheet(worksheet))
    return with_organisation(per_org_year(rows, largest_each(lines)), trusts)
