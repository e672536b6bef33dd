"""Line-item rows with labels, in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions.text import is_current_year
from ledgerwide.operators.resolve import known_rows

INCOME_CATEGORIES = ["PATIENT_INCOME", "OTHER_INCOME", "TOTAL_INCOME"]


def income_detail(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> DataFrame:
    """Income lines of three schedules, subtotals included."""
    rows = fact.where(F.col("worksheet_name").isin(ref.INCOME_1, ref.INCOME_2, ref.SOCI))
    labels = codes.where(F.col("analytics_category").isin(INCOME_CATEGORIES))
    columns = [
        "org_code", "organisation_name", "sector", "region", "trust_type",
        "financial_year", "worksheet_name", "sub_code",
        F.col("description").alias("sub_code_description"), "is_subtotal",
        F.col("total_000s").alias("value_000s"),
    ]
    return known_rows(rows.drop("trust_type"), trusts, labels, _plain(columns))


def expenditure_detail(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> DataFrame:
    """Expenditure lines, subtotals included."""
    rows = fact.where(F.col("worksheet_name") == ref.EXPENDITURE)
    columns = [
        "org_code", "organisation_name", "sector", "region", "trust_type", "financial_year",
        "sub_code", F.col("description").alias("sub_code_description"), "analytics_category",
        "is_subtotal", F.col("total_000s").alias("value_000s"),
    ]
    return known_rows(rows.drop("trust_type"), trusts, codes, _plain(columns))


def line_items(
    fact: DataFrame, trusts: DataFrame, codes: DataFrame, worksheets: list[str]
) -> DataFrame:
    """Current-year lines of some schedules without subtotals, as exported."""
    rows = fact.where(F.col("worksheet_name").isin(worksheets) & is_current_year("main_code"))
    labels = codes.where(F.col("is_subtotal") == 0)
    columns = [
        "org_code", "organisation_name", "sector", "trust_type", "financial_year", "sub_code",
        F.col("description").alias("line_item"), "analytics_category",
        F.col("total_000s").cast("bigint").alias("amount_000s"),
    ]
    return known_rows(rows.drop("trust_type"), trusts, labels, _plain(columns))


def _plain(columns: list) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in columns]
