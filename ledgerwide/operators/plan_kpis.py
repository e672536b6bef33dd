"""KPIs that compare with a plan, ceiling or target.

Inputs are long frames with the columns each function names; they are aggregated
by the caller's keys first, so only one row per key is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import numeric as num
from ledgerwide.functions import status
from ledgerwide.operators.yoy import year_to_date

# Bands and ceiling in percent.
CAPITAL_GREEN = (90.0, 110.0)
CAPITAL_AMBER_FROM = 75.0
AGENCY_CEILING = 3.5
VARIANCE_AMBER = 2.0


def _sums(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in columns))


def savings_achievement(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delivered against target: Green from 100 %, Amber from 80 %."""
    table = _sums(df, keys, "delivered_000s", "target_000s")
    share = num.ratio("delivered_000s", "target_000s", 100.0)
    return table.select(
        "*",
        F.round(share, 1).alias("achievement_pct"),
        status.CIP_BANDS.status(share, when_null="Grey").alias("rag"),
    )


def variance_status(variance_pct: Column, is_income: Column) -> Column:
    """Income below plan and spending above plan are bad: two points are the Amber band."""
    good = F.when(is_income, variance_pct).otherwise(-variance_pct)
    return (
        F.when(variance_pct.isNull(), "Grey")
        .when(good >= 0, "Green")
        .when(good >= -VARIANCE_AMBER, "Amber")
        .otherwise("Red")
    )


def budget_variance(
    df: DataFrame, keys: Sequence[str], period: str = "period", kind: str = "account_type"
) -> DataFrame:
    """Monthly and year-to-date variance. ``keys`` hold the year and the account type."""
    table = _sums(df, [*keys, period], "actual_000s", "budget_000s")
    table = table.withColumns(
        {
            "ytd_actual_000s": year_to_date("actual_000s", keys, period),
            "ytd_budget_000s": year_to_date("budget_000s", keys, period),
        }
    )
    variance = F.col("actual_000s") - F.col("budget_000s")
    ytd = F.col("ytd_actual_000s") - F.col("ytd_budget_000s")
    is_income = F.col(kind) == "INCOME"
    share = num.ratio(variance, F.abs("budget_000s"), 100.0)
    favourable = F.when(is_income, variance >= 0).otherwise(variance <= 0)
    return table.select(
        *keys,
        period,
        "actual_000s",
        "budget_000s",
        variance.alias("variance_000s"),
        F.round(share, 1).alias("variance_pct"),
        F.when(favourable, "FAV").otherwise("ADV").alias("direction"),
        variance_status(share, is_income).alias("rag"),
        ytd.alias("ytd_variance_000s"),
        F.round(num.ratio(ytd, F.abs("ytd_budget_000s"), 100.0), 1).alias("ytd_variance_pct"),
    )


def capital_spend(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spend against plan: Green 90-110 %, Amber 75-90 %, else Red."""
    table = _sums(df, keys, "actual_000s", "plan_000s")
    share = num.ratio("actual_000s", "plan_000s", 100.0)
    rag = (
        F.when(share.isNull(), "Grey")
        .when(share.between(*CAPITAL_GREEN), "Green")
        .when((share >= CAPITAL_AMBER_FROM) & (share < CAPITAL_GREEN[0]), "Amber")
        .otherwise("Red")
    )
    return table.select("*", F.round(share, 1).alias("spend_pct"), rag.alias("rag"))


def agency_share(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Agency cost as a share of pay including agency; 1 when above the ceiling."""
    table = _sums(df, keys, "agency_000s", "pay_000s")
    share = num.ratio("agency_000s", F.col("pay_000s") + F.col("agency_000s"), 100.0)
    return table.select(
        "*",
        F.round(share, 1).alias("agency_pct"),
        F.coalesce((share >= AGENCY_CEILING).cast("int"), F.lit(0)).alias("over_ceiling"),
    )
