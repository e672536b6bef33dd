"""String rules for names, codes and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two provider classes carried in the data.
NHS_TRUST = "NHS_TRUST"
FOUNDATION_TRUST = "FOUNDATION_TRUST"

# Fixed value: four-digit year, dash, two-digit year in a file name.
YEAR_IN_NAME = r"(\d{4})-(\d{2})"


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def financial_year_from_name(name: str | Column, strict: bool = True) -> Column:
    """``..._2023-24.csv`` -> ``2023/24``. A name without a year raises, or is null if not strict."""
    name = col(name)
    label = F.replace(F.regexp_extract(name, YEAR_IN_NAME, 0), F.lit("-"), F.lit("/"))
    missing = (
        F.raise_error(F.concat(F.lit("no financial year in file name: "), name)).cast("string")
        if strict
        else F.lit(None).cast("string")
    )
    # The pattern is matched once a row.
    return F.coalesce(F.nullif(label, F.lit("")), missing)


def trust_type_from_name(name: str | Column) -> Column:
    is_foundation = F.lower(col(name)).contains("foundation")
    return F.when(is_foundation, FOUNDATION_TRUST).otherwise(NHS_TRUST)


def year_type(main_code: str | Column) -> Column:
    """``PY`` for prior-year comparatives, else ``CY`` (a null code counts as current year)."""
    return F.when(col(main_code).contains("PY"), "PY").otherwise("CY")


def is_current_year(main_code: str | Column) -> Column:
    return ~col(main_code).like("%PY%")


def thousands(value: Column, places: int) -> Column:
    """Number as text with thousands separators and exactly ``places`` decimals.

    Rounds half away from zero first: ``format_number`` alone rounds half to even.
    """
    return F.format_number(F.round(value, places), places)


def plain_decimal(value: Column, places: int = 1) -> Column:
    """Number as text with fixed decimals and no separators."""
    return value.cast(f"decimal(20,{places})").cast("string")


def percent_text(value: str | Column, places: int = 1) -> Column:
    return F.concat(plain_decimal(col(value), places), F.lit("%"))


def signed_points_text(value: str | Column, places: int = 1) -> Column:
    """``+1.2pp`` for gains, ``-1.2pp`` or ``0.0pp`` otherwise, null for null."""
    value = col(value)
    text = F.concat(plain_decimal(value, places), F.lit("pp"))
    return F.when(value > 0, F.concat(F.lit("+"), text)).otherwise(text)


def deficit_text(flag: str | Column) -> Column:
    return F.when(col(flag) == 1, "DEFICIT").otherwise("SURPLUS")
