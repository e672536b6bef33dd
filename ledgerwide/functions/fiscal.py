"""April-to-March financial years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.functions.text import col

FIRST_MONTH = 4


def start_year(date: str | Column) -> Column:
    """Calendar year in which the financial year of ``date`` begins."""
    return F.year(F.add_months(col(date).cast("date"), 1 - FIRST_MONTH))


def label_of(start: str | Column) -> Column:
    """1999 -> ``1999/00``."""
    start = col(start)
    return F.format_string("%04d/%02d", start, (start + 1) % 100)


def short_label_of(start: str | Column) -> Column:
    start = col(start)
    return F.format_string("%02d/%02d", start % 100, (start + 1) % 100)


def label(date: str | Column) -> Column:
    return label_of(start_year(date))


def start_of_label(financial_year: str | Column) -> Column:
    return F.substring(col(financial_year), 1, 4).cast("int")


def prior_label(financial_year: str | Column) -> Column:
    return label_of(start_of_label(financial_year) - 1)


def first_day(start: str | Column) -> Column:
    return F.make_date(col(start), F.lit(FIRST_MONTH), F.lit(1))


def last_day(start: str | Column) -> Column:
    return F.date_sub(F.make_date(col(start) + 1, F.lit(FIRST_MONTH), F.lit(1)), 1)


def period_number(date: str | Column) -> Column:
    """April = 1 ... March = 12."""
    return F.month(F.add_months(col(date).cast("date"), 1 - FIRST_MONTH))


def period(date: str | Column) -> Column:
    return F.format_string("M%02d", period_number(date))


def quarter(date: str | Column) -> Column:
    return F.format_string("Q%d", F.ceil(period_number(date) / 3).cast("int"))


def shift_label(financial_year: str, years: int) -> str:
    """Driver-side label arithmetic: (``2000/01``, -1) -> ``1999/00``."""
    start = int(financial_year[:4]) + years
    return f"{start:04d}/{(start + 1) % 100:02d}"


def year_dimension(spark: SparkSession, first: int, last: int, complete_to: int | None = None) -> DataFrame:
    """Generated year dimension, one row per start year in [first, last]."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    return describe_years(years, "y", complete_to)


def describe_years(years: DataFrame, start: str, complete_to: int | None = None) -> DataFrame:
    complete = F.lit(1) if complete_to is None else (F.col(start) <= complete_to).cast("int")
    return years.select(
        label_of(start).alias("financial_year"),
        first_day(start).alias("start_date"),
        last_day(start).alias("end_date"),
        short_label_of(start).alias("year_label_short"),
        complete.alias("is_complete"),
    )
