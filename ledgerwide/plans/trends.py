"""Sector trend analyses over the scorecard.

Every function takes the scorecard (one row per organisation and year); a year
argument picks the reporting year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import numeric as num
from ledgerwide.functions import text
from ledgerwide.operators import ranking

YEAR = "2023/24"


def millions_text(column: str, places: int = 0) -> Column:
    return text.thousands(num.in_units(F.sum(column), num.MILLIONS), places)


def billions_text(column: str, places: int = 1) -> Column:
    return text.thousands(num.in_units(F.sum(column), num.BILLIONS), places)


def row_millions_text(column: str | Column, places: int = 0) -> Column:
    return text.thousands(num.in_units(column, num.MILLIONS), places)


def share_of_income(column: str, places: int = 1) -> Column:
    """Ratio of sums: the weighted share, not the mean of shares."""
    return num.percent(F.sum(column), F.sum("total_income_000s"), places)


def mean_share_of_income(column: str, places: int = 1) -> Column:
    """Mean of each organisation's own share."""
    return num.rounded_mean(num.ratio(column, "total_income_000s", 100.0), places, scale=6)


def national_trend(scorecard: DataFrame) -> DataFrame:
    """T1. Income, expenditure and surplus by year."""
    return (
        scorecard.groupBy("financial_year")
        .agg(
            billions_text("total_income_000s").alias("total_income_bn"),
            billions_text("total_expenditure_000s").alias("total_expenditure_bn"),
            millions_text("operating_surplus_000s").alias("op_surplus_m"),
            millions_text("net_surplus_000s").alias("net_surplus_m"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_pct"),
            F.sum("is_deficit").alias("deficit_trusts"),
            F.count("*").alias("total_trusts"),
        )
        .orderBy("financial_year")
    )


def sector_comparison(scorecard: DataFrame, year: str = YEAR) -> DataFrame:
    """T2. KPIs by sector and trust type."""
    surplus = F.col("operating_surplus_000s")
    deficit = F.sum(F.when(surplus < 0, surplus).otherwise(0))
    return (
        scorecard.where(F.col("financial_year") == year)
        .groupBy("sector", "trust_type")
        .agg(
            F.count("*").alias("providers"),
            millions_text("total_income_000s").alias("total_income_m"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct"),
            num.rounded_mean("net_surplus_margin_pct").alias("avg_net_surplus_pct"),
            F.sum("is_deficit").alias("deficit_count"),
            row_millions_text(deficit).alias("total_deficit_m"),
        )
        .orderBy("sector", "trust_type")
    )


def region_growth(scorecard: DataFrame, years: Sequence[str]) -> DataFrame:
    """T3. Income by region for three years and growth over the first to the last.

    Columns are named after the years: ``income_2122_000s`` for 2021/22.
    """
    by_year = {
        y: F.sum(F.when(F.col("financial_year") == y, F.col("total_income_000s"))) for y in years
    }
    first, last = by_year[years[0]], by_year[years[-1]]
    names = {y: f"income_{y[2:4]}{y[5:7]}_000s" for y in years}
    return (
        scorecard.where("region IS NOT NULL")
        .groupBy("region")
        .agg(
            *(total.alias(names[y]) for y, total in by_year.items()),
            F.round(num.ratio(last - first, first, 100.0), 1).alias("growth_2yr_pct"),
        )
        .orderBy(F.col(names[years[-1]]).desc_nulls_last(), "region")
    )


def region_pivot(scorecard: DataFrame, years: Sequence[str]) -> DataFrame:
    """A4. The same totals by ``pivot`` with stated values, so no pass looks for them."""
    return scorecard.groupBy("region").pivot("financial_year", list(years)).sum("total_income_000s")


def ebitda_distribution(scorecard: DataFrame, year: str = YEAR) -> DataFrame:
    """T4. Spread of margins by sector. A margin of exactly 2.0 counts in both middle bands."""
    margin = F.col("ebitda_margin_pct")
    return (
        scorecard.where((F.col("financial_year") == year) & F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(
            F.round(F.min(margin), 1).alias("min_ebitda_pct"),
            num.rounded_mean(margin).alias("avg_ebitda_pct"),
            F.round(F.max(margin), 1).alias("max_ebitda_pct"),
            num.count_if(margin < 0).alias("negative_ebitda"),
            num.count_if(margin.between(0, 2)).alias("low_0_2"),
            num.count_if(margin.between(2, 5)).alias("mid_2_5"),
            num.count_if(margin > 5).alias("high_gt5"),
        )
        .orderBy(F.col("avg_ebitda_pct").desc_nulls_last(), "sector")
    )


def largest_by_income(scorecard: DataFrame, year: str = YEAR, limit: int = 20) -> DataFrame:
    """T5. Largest organisations."""
    rows = scorecard.where(F.col("financial_year") == year)
    order = [F.col("total_income_000s").desc_nulls_last()]
    return ranking.top_ranked(rows, order, "org_code", limit, "rank").select(
        "rank", "organisation_name", "sector", "region",
        row_millions_text("total_income_000s").alias("income_m"),
        row_millions_text("operating_surplus_000s").alias("op_surplus_m"),
        text.percent_text("ebitda_margin_pct").alias("ebitda_margin"),
        text.percent_text("pay_pct_income").alias("pay_pct"),
        text.deficit_text("is_deficit").alias("status"),
    )


def weakest_by_margin(scorecard: DataFrame, year: str = YEAR, limit: int = 20) -> DataFrame:
    """T6. Lowest net surplus margins; a missing margin sorts first."""
    rows = scorecard.where(F.col("financial_year") == year)
    order = [F.col("net_surplus_margin_pct").asc_nulls_first()]
    return ranking.top_ranked(rows, order, "org_code", limit, "deficit_rank").select(
        "deficit_rank", "organisation_name", "sector", "region", "trust_type",
        row_millions_text("total_income_000s").alias("income_m"),
        row_millions_text("net_surplus_000s").alias("net_surplus_m"),
        text.percent_text("net_surplus_margin_pct").alias("net_margin"),
        text.percent_text("ebitda_margin_pct").alias("ebitda_margin"),
    )


def pay_trend(scorecard: DataFrame) -> DataFrame:
    """T7. Pay share by year and sector, as mean of shares and as weighted share."""
    return (
        scorecard.where("sector IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct"),
            F.round(num.in_units(F.sum("pay_000s"), num.BILLIONS), 1).alias("total_pay_bn"),
            F.round(num.in_units(F.sum("total_income_000s"), num.BILLIONS), 1).alias(
                "total_income_bn"
            ),
            share_of_income("pay_000s").alias("sector_pay_pct"),
        )
        .orderBy("financial_year", "sector")
    )


def drugs_cost(scorecard: DataFrame, sectors: Sequence[str] = ("Acute", "Specialist")) -> DataFrame:
    """T8. Drugs cost for some sectors."""
    return (
        scorecard.where(F.col("sector").isin(list(sectors)) & F.col("drugs_cost_000s").isNotNull())
        .groupBy("financial_year", "sector")
        .agg(
            millions_text("drugs_cost_000s").alias("total_drugs_m"),
            share_of_income("drugs_cost_000s").alias("drugs_pct_income"),
            mean_share_of_income("drugs_cost_000s").alias("avg_drugs_pct"),
        )
        .orderBy("financial_year", "sector")
    )


def negligence_by_year(scorecard: DataFrame) -> DataFrame:
    """T9. Clinical negligence cost by year."""
    return (
        scorecard.where("clinical_negligence_000s IS NOT NULL")
        .groupBy("financial_year")
        .agg(
            millions_text("clinical_negligence_000s").alias("total_neg_m"),
            share_of_income("clinical_negligence_000s").alias("neg_pct_income"),
            F.count("org_code").alias("trusts_reporting"),
        )
        .orderBy("financial_year")
    )


def finance_lines(scorecard: DataFrame) -> DataFrame:
    """T10. Finance income against finance expense and dividend, signs as stored."""
    income, expense, dividend = (
        F.sum(c) for c in ("finance_income_000s", "finance_expense_000s", "pdc_dividend_000s")
    )
    return (
        scorecard.where("finance_income_000s IS NOT NULL")
        .groupBy("financial_year")
        .agg(
            millions_text("finance_income_000s").alias("finance_income_m"),
            millions_text("finance_expense_000s").alias("finance_expense_m"),
            millions_text("pdc_dividend_000s").alias("pdc_dividend_m"),
            row_millions_text(income - expense - dividend).alias("net_finance_m"),
        )
        .orderBy("financial_year")
    )
