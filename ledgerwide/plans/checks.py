"""Validation queries that show figures for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import numeric as num
from ledgerwide.functions import text
from ledgerwide.operators import ranking
from ledgerwide.plans.trends import YEAR, billions_text, row_millions_text


def rows_by_scope(fact: DataFrame) -> DataFrame:
    """C1. Providers and rows by year and trust type.

    The distinct count is two hash aggregates (per organisation, then per scope),
    so no scope has to fit in one task.
    """
    per_org = fact.groupBy("financial_year", "trust_type", "org_code").agg(F.count("*").alias("n"))
    return (
        per_org.groupBy("financial_year", "trust_type")
        .agg(
            F.count("org_code").alias("providers"),
            text.thousands(num.real(F.sum("n")), 0).alias("total_rows"),
        )
        .orderBy("financial_year", "trust_type")
    )


def patient_income(fact: DataFrame) -> DataFrame:
    """C2. Patient care income by year."""
    return (
        fact.where("sub_code = 'SCI0100A'")
        .groupBy("financial_year")
        .agg(
            billions_text("total_000s").alias("patient_income_bn"),
            F.countDistinct("org_code").alias("providers"),
        )
        .orderBy("financial_year")
    )


def income_expenditure_by_year(summary: DataFrame) -> DataFrame:
    """C3. Summary of the income statement by year."""
    return (
        summary.groupBy("financial_year")
        .agg(
            billions_text("patient_care_income_000s").alias("patient_income_bn"),
            billions_text("other_income_000s").alias("other_income_bn"),
            billions_text("total_income_000s").alias("total_income_bn"),
            billions_text("total_expenditure_000s").alias("total_exp_bn"),
            billions_text("operating_surplus_000s").alias("op_surplus_bn"),
            F.count("org_code").alias("providers"),
        )
        .orderBy("financial_year")
    )


def kpis_by_sector(kpis: DataFrame, year: str = YEAR) -> DataFrame:
    """C4. KPI means by sector and trust type."""
    return (
        kpis.where((F.col("financial_year") == year) & (F.col("total_income_000s") > 0))
        .groupBy("sector", "trust_type")
        .agg(
            F.count("org_code").alias("providers"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_margin_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct_income"),
            num.rounded_mean("net_surplus_margin_pct").alias("avg_net_surplus_pct"),
        )
        .orderBy("sector", "trust_type")
    )


def deficit_summary(summary: DataFrame, year: str = YEAR) -> DataFrame:
    """C5. Deficits and surpluses, counts and totals."""
    surplus = F.col("operating_surplus_000s")

    def total(condition: Column) -> Column:
        return row_millions_text(F.sum(F.when(condition, surplus).otherwise(0)), 1)

    return summary.where(F.col("financial_year") == year).agg(
        num.count_if(surplus < 0).alias("deficit_trusts"),
        num.count_if(surplus >= 0).alias("surplus_trusts"),
        F.count("*").alias("total_trusts"),
        total(surplus < 0).alias("total_deficit_m"),
        total(surplus >= 0).alias("total_surplus_m"),
    )


def _listing(rows: DataFrame, margin: str, name: str) -> DataFrame:
    return rows.select(
        "organisation_name", "sector", "trust_type",
        row_millions_text("total_income_000s", 1).alias("total_income_m"),
        row_millions_text("operating_surplus_000s", 1).alias("op_surplus_m"),
        text.percent_text(margin).alias(name),
    )


def largest(kpis: DataFrame, year: str = YEAR, limit: int = 10) -> DataFrame:
    """C6. Largest organisations by income."""
    rows = kpis.where(F.col("financial_year") == year)
    order = [F.col("total_income_000s").desc_nulls_last()]
    return _listing(
        ranking.top(rows, order, "org_code", limit), "net_surplus_margin_pct", "net_margin"
    )


def largest_deficits(kpis: DataFrame, year: str = YEAR, limit: int = 10) -> DataFrame:
    """C7. Largest operating deficits."""
    rows = kpis.where(
        (F.col("financial_year") == year) & F.col("operating_surplus_000s").isNotNull()
    )
    order = [F.col("operating_surplus_000s").asc()]
    return _listing(
        ranking.top(rows, order, "org_code", limit), "ebitda_margin_pct", "ebitda_margin"
    )


def cost_mix(breakdown: DataFrame) -> DataFrame:
    """C8. Pay, drugs and non-pay by year."""
    return (
        breakdown.groupBy("financial_year")
        .agg(
            billions_text("pay_000s").alias("total_pay_bn"),
            billions_text("drugs_cost_000s").alias("total_drugs_bn"),
            billions_text("non_pay_000s").alias("total_non_pay_bn"),
            billions_text("total_expenditure_000s").alias("total_exp_bn"),
            num.percent(F.sum("pay_000s"), F.sum("total_expenditure_000s")).alias("pay_pct_exp"),
        )
        .orderBy("financial_year")
    )


def workforce_by_year(workforce: DataFrame) -> DataFrame:
    """C9. WTE, staff cost and cost per WTE, in thousands."""
    return (
        workforce.where("total_wte IS NOT NULL")
        .groupBy("financial_year")
        .agg(
            text.thousands(num.real(F.sum("total_wte")), 0).alias("total_wte"),
            billions_text("total_staff_cost_000s").alias("staff_cost_bn"),
            F.round(num.ratio(F.sum("total_staff_cost_000s"), F.sum("total_wte")), 1).alias(
                "avg_cost_per_wte_000s"
            ),
        )
        .orderBy("financial_year")
    )


def key_uniqueness(fact: DataFrame) -> DataFrame:
    """C10. Rows against distinct keys: equal when no key repeats."""
    keyed = fact.groupBy("org_code", "financial_year", "main_code", "sub_code").agg(
        F.count("*").alias("n")
    )
    return keyed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_keys")
    )
