"""Columns added to the scorecard after it is built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import numeric as num
from ledgerwide.functions import status
from ledgerwide.operators.yoy import prior_row


def normalise_sectors(df: DataFrame) -> DataFrame:
    return df.withColumn("sector", status.canonical_sector("sector"))


def add_flags(df: DataFrame) -> DataFrame:
    """Size, pay pressure (unknown sector: 0) and EBITDA status (missing margin: null)."""
    return df.withColumns(
        {
            "is_large": status.is_large("total_income_000s"),
            "pay_pressure_flag": status.pay_pressure_flag("pay_pct_income", "sector"),
            "ebitda_rag": status.EBITDA_BANDS.status("ebitda_margin_pct", when_null=None),
        }
    )


def add_income_mix(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "patient_income_pct": num.percent("patient_care_income_000s", "total_income_000s"),
            "other_income_pct": num.percent("other_income_000s", "total_income_000s"),
        }
    )


def add_ebitda_change(df: DataFrame) -> DataFrame:
    """Change against the organisation's previous row."""
    before = F.col("ebitda_margin_pct_prior_yr")
    return df.withColumn("ebitda_margin_pct_prior_yr", prior_row("ebitda_margin_pct")).withColumn(
        "ebitda_margin_yoy_pp", F.round(F.col("ebitda_margin_pct") - before, 1)
    )


def enriched(scorecard: DataFrame) -> DataFrame:
    return (
        scorecard.transform(normalise_sectors)
        .transform(add_flags)
        .transform(add_income_mix)
        .transform(add_ebitda_change)
    )


# Columns of the enriched datasets.
#: The column lists of the four exports.
KPI_EXPORT = [
    "org_code", "organisation_name", "sector", "region", "trust_type", "financial_year",
    "total_income_000s", "ebitda_000s", "ebitda_margin_pct", "pay_000s", "pay_pct_income",
    "total_wte", "cost_per_wte_000s", "net_surplus_000s", "net_surplus_margin_pct", "is_deficit",
    "is_large", "pay_pressure_flag", "ebitda_rag", "ebitda_margin_yoy_pp",
]
INCOME_EXPORT = [
    "org_code", "financial_year", "total_income_000s", "patient_care_income_000s",
    "other_income_000s", "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
    "patient_income_pct", "other_income_pct",
]
EXPENDITURE_EXPORT = [
    "org_code", "financial_year", "pay_000s", "non_pay_000s", "depreciation_amort_000s",
    "drugs_cost_000s", "clinical_negligence_000s", "clinical_supplies_000s", "general_supplies_000s",
]
WORKFORCE_EXPORT = [
    "org_code", "financial_year", "total_wte", "total_staff_cost_000s", "gross_staff_cost_000s",
    "medical_wte", "nursing_wte",
]
