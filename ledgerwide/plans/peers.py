"""Peer and benchmark analyses over the scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import fiscal, status, text
from ledgerwide.functions import numeric as num
from ledgerwide.operators import ranking, yoy
from ledgerwide.plans.trends import (
    YEAR,
    mean_share_of_income,
    millions_text,
    row_millions_text,
    share_of_income,
)

# Display names of the income quartiles.
SIZE_BANDS = {
    1: "Q1 — Smallest (<£200m)",
    2: "Q2 — Small–Medium (£200–400m)",
    3: "Q3 — Medium–Large (£400–800m)",
    4: "Q4 — Largest (>£800m)",
}

# Fixed value: working days in a year, for the cost of a lost day.
WORKING_DAYS = 225


def income_quartiles(scorecard: DataFrame) -> DataFrame:
    """W1. Income quartile of every organisation within its year; code breaks ties."""
    rows = scorecard.where("total_income_000s > 0")
    order = [F.col("total_income_000s"), F.col("org_code")]
    return ranking.tiles(rows, ["financial_year"], order, 4, "income_quartile")


def size_bands(scorecard: DataFrame, year: str = YEAR) -> DataFrame:
    """B1. KPIs by income quartile."""
    columns = [
        "org_code", "financial_year", "total_income_000s", "ebitda_margin_pct", "pay_pct_income",
        "cost_per_wte_000s", "is_deficit",
    ]
    banded = income_quartiles(scorecard.where(F.col("financial_year") == year).select(*columns))
    quartile = F.col("income_quartile")
    label = F.when(quartile == 1, SIZE_BANDS[1])
    for q in (2, 3, 4):
        label = label.when(quartile == q, SIZE_BANDS[q])
    return (
        banded.groupBy("income_quartile")
        .agg(
            F.count("*").alias("trust_count"),
            row_millions_text(F.min("total_income_000s")).alias("min_income_m"),
            row_millions_text(F.max("total_income_000s")).alias("max_income_m"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct"),
            num.rounded_mean("cost_per_wte_000s").alias("avg_cost_per_wte_000s"),
            F.sum("is_deficit").alias("deficit_trusts"),
        )
        .withColumn("size_band", label)
        .orderBy("income_quartile")
    )


def type_comparison(scorecard: DataFrame) -> DataFrame:
    """B2. Trust types by year."""
    return (
        scorecard.where("trust_type IS NOT NULL")
        .groupBy("financial_year", "trust_type")
        .agg(
            F.count("*").alias("providers"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct"),
            num.rounded_mean("net_surplus_margin_pct").alias("avg_net_surplus_pct"),
            F.sum("is_deficit").alias("deficit_count"),
            millions_text("operating_surplus_000s").alias("total_surplus_m"),
            text.thousands(num.in_units(F.sum("total_income_000s"), num.BILLIONS), 1).alias(
                "total_income_bn"
            ),
        )
        .orderBy("financial_year", "trust_type")
    )


def pay_pressure(scorecard: DataFrame, year: str = YEAR, limit: int = 30) -> DataFrame:
    """B3. Organisations above their sector's pay threshold, furthest above first."""
    threshold = status.pay_threshold("sector")
    rows = (
        scorecard.where((F.col("financial_year") == year) & (F.col("pay_pct_income") > threshold))
        .withColumn("sector_amber_threshold_pct", threshold)
        .withColumn("excess_pp", F.round(F.col("pay_pct_income") - threshold, 1))
    )
    kept = ranking.top(rows, [F.col("excess_pp").desc_nulls_last()], "org_code", limit)
    return kept.select(
        "organisation_name", "sector", "region", "trust_type", "financial_year",
        text.percent_text("pay_pct_income").alias("pay_pct"),
        "sector_amber_threshold_pct", "excess_pp",
        text.percent_text("ebitda_margin_pct").alias("ebitda_margin"),
    )


def regional_health(scorecard: DataFrame, year: str = YEAR) -> DataFrame:
    """B4. Regions, most deficits first."""
    return (
        scorecard.where((F.col("financial_year") == year) & F.col("region").isNotNull())
        .groupBy("region")
        .agg(
            F.count("org_code").alias("trusts"),
            millions_text("total_income_000s").alias("total_income_m"),
            millions_text("operating_surplus_000s").alias("total_surplus_m"),
            share_of_income("operating_surplus_000s").alias("sector_op_margin_pct"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct"),
            F.sum("is_deficit").alias("deficit_trusts"),
            num.percent(F.sum("is_deficit"), F.count("*"), 0).alias("deficit_pct"),
        )
        .orderBy(F.col("deficit_pct").desc(), "region")
    )


def cost_per_wte(scorecard: DataFrame) -> DataFrame:
    """B5. Cost per WTE by year and sector."""
    rows = scorecard.where(
        "sector IS NOT NULL AND total_wte > 0 AND cost_per_wte_000s IS NOT NULL"
    )
    cost = F.col("cost_per_wte_000s")
    return (
        rows.groupBy("financial_year", "sector")
        .agg(
            F.count("*").alias("trusts"),
            num.rounded_mean(cost).alias("avg_cost_per_wte_000s"),
            F.round(F.min(cost), 1).alias("min_cost_per_wte_000s"),
            F.round(F.max(cost), 1).alias("max_cost_per_wte_000s"),
            millions_text("total_staff_cost_000s").alias("total_pay_bill_m"),
            text.thousands(num.real(F.sum("total_wte")), 0).alias("total_wte"),
        )
        .orderBy("financial_year", "sector")
    )


def private_income(scorecard: DataFrame, year: str = YEAR, limit: int = 25) -> DataFrame:
    """B6. Largest private patient income."""
    rows = scorecard.where(
        (F.col("financial_year") == year) & (F.col("private_patient_income_000s") > 0)
    )
    order = [F.col("private_patient_income_000s").desc()]
    return ranking.top(rows, order, "org_code", limit).select(
        "organisation_name", "sector", "region", "financial_year",
        row_millions_text("private_patient_income_000s", 1).alias("private_income_m"),
        row_millions_text("total_income_000s").alias("total_income_m"),
        num.percent("private_patient_income_000s", "total_income_000s", 2).alias("private_pct"),
    )


def negligence_by_sector(scorecard: DataFrame) -> DataFrame:
    """B7. Clinical negligence by year and sector, weighted share and mean share."""
    return (
        scorecard.where("clinical_negligence_000s IS NOT NULL AND sector IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(
            F.count("org_code").alias("trusts_reporting"),
            millions_text("clinical_negligence_000s").alias("total_neg_m"),
            share_of_income("clinical_negligence_000s", 2).alias("neg_pct_income"),
            mean_share_of_income("clinical_negligence_000s", 2).alias("avg_neg_pct_per_trust"),
        )
        .orderBy("financial_year", F.col("neg_pct_income").desc_nulls_last(), "sector")
    )


def ebitda_movers(scorecard: DataFrame, year: str = YEAR, limit: int = 30) -> DataFrame:
    """B8. Largest falls in EBITDA margin against the year before.

    Column suffixes name the years, as in ``ebitda_2324``.
    """
    before = fiscal.shift_label(year, -1)
    now_tag, before_tag = (y[2:4] + y[5:7] for y in (year, before))
    pairs = yoy.year_pair(
        scorecard.where("total_income_000s > 0"),
        "org_code",
        year,
        before,
        keep=["organisation_name", "sector", "region", "is_deficit", "total_income_000s"],
        compare=["ebitda_margin_pct"],
    )
    change = F.round(F.col("ebitda_margin_pct") - F.col("ebitda_margin_pct_prior"), 1)
    rows = pairs.withColumn("change", change)
    kept = ranking.top(rows, [F.col("change").asc_nulls_first()], "org_code", limit)
    return kept.select(
        "organisation_name", "sector", "region",
        row_millions_text("total_income_000s").alias("income_m"),
        text.percent_text("ebitda_margin_pct_prior").alias(f"ebitda_{before_tag}"),
        text.percent_text("ebitda_margin_pct").alias(f"ebitda_{now_tag}"),
        text.signed_points_text("change").alias("yoy_change"),
        text.deficit_text("is_deficit").alias(f"status_{now_tag}"),
    )


def sickness(scorecard_with_sickness: DataFrame) -> DataFrame:
    """B9. Days lost and their estimated cost, by year and sector.

    Needs ``avg_days_lost_per_wte`` beside the scorecard columns.
    """
    rows = scorecard_with_sickness.where(
        "avg_days_lost_per_wte IS NOT NULL AND total_wte > 0 "
        "AND cost_per_wte_000s IS NOT NULL AND sector IS NOT NULL"
    )
    # Days and WTE are whole and cost has one decimal: tenths keep the sum exact.
    tenths = F.round(F.col("cost_per_wte_000s") * 10, 0).cast("bigint")
    lost = F.sum((F.col("avg_days_lost_per_wte") * F.col("total_wte") * tenths).cast("decimal(24,0)"))
    cost = lost.cast("double") / F.lit(10.0 * WORKING_DAYS)
    return (
        rows.groupBy("financial_year", "sector")
        .agg(
            F.count("*").alias("trusts"),
            num.rounded_mean("avg_days_lost_per_wte").alias("avg_days_lost_per_wte"),
            text.thousands(num.real(F.sum("total_wte")), 0).alias("total_wte"),
            row_millions_text(cost).alias("est_sickness_cost_m"),
        )
        .orderBy("financial_year", F.col("avg_days_lost_per_wte").desc_nulls_last(), "sector")
    )


def academic_income(scorecard: DataFrame, year: str = YEAR, limit: int = 25) -> DataFrame:
    """B10. Research and education income, largest first by amount (not by its text)."""
    both = F.coalesce("rd_income_000s", F.lit(0)) + F.coalesce(
        "education_training_income_000s", F.lit(0)
    )
    rows = scorecard.where(
        (F.col("financial_year") == year)
        & ((F.col("rd_income_000s") > 0) | (F.col("education_training_income_000s") > 0))
    ).withColumn("academic", both)
    return ranking.top(rows, [F.col("academic").desc()], "org_code", limit).select(
        "organisation_name", "sector", "region", "financial_year",
        row_millions_text("rd_income_000s", 1).alias("rd_income_m"),
        row_millions_text("education_training_income_000s", 1).alias("education_income_m"),
        row_millions_text("academic", 1).alias("rd_edu_total_m"),
        num.percent("academic", "total_income_000s").alias("rd_edu_pct_income"),
        text.percent_text("ebitda_margin_pct").alias("ebitda_margin"),
    )
