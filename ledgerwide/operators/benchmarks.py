"""Sector benchmarks.

Inputs hold one row per organisation and year (the KPI view and the scorecard do).
Within a year, counting rows therefore counts organisations, and the extra shuffle
of a distinct count, which would carry every aggregate's state per organisation,
is not needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwide.functions import numeric as num
from ledgerwide.session import scratch_root


def exact_quantile(value: str, share: float, scale: int = 1) -> Column:
    """Interpolated quantile of a column held to ``scale`` decimals.

    The aggregate keeps one counter per distinct value and merges counters on the
    map side, so its state follows the number of distinct rounded values and not
    the number of rows. Whole steps keep the interpolation exact.
    """
    steps = F.round(F.col(value) * 10**scale, 0).cast("bigint")
    return F.percentile(steps, F.lit(share))


def exact_median(value: str, scale: int = 1) -> Column:
    return F.round(exact_quantile(value, 0.5, scale), 0) / 10**scale


def sector_benchmarks(scorecard: DataFrame) -> DataFrame:
    """Eleven metrics by year and sector, and the sector's weighted pay share.

    Rows without a sector are left out, as in a keyed group-by on the label.
    """
    grouped = (
        scorecard.where("sector IS NOT NULL")
        .groupBy("financial_year", "sector")
        .agg(
            F.count("org_code").alias("providers"),
            F.sum("total_income_000s").alias("total_income_000s"),
            F.sum("total_expenditure_000s").alias("total_expenditure_000s"),
            F.coalesce(F.sum("operating_surplus_000s"), F.lit(0)).alias("total_surplus_000s"),
            F.coalesce(F.sum("pay_000s"), F.lit(0)).alias("total_pay_000s"),
            F.coalesce(F.sum("total_wte"), F.lit(0)).alias("total_wte"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_margin_pct"),
            exact_median("ebitda_margin_pct").alias("median_ebitda_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct_income"),
            num.rounded_mean("cost_per_wte_000s").alias("avg_cost_per_wte_000s"),
            F.sum("is_deficit").alias("deficit_trusts"),
        )
    )
    return grouped.withColumn("sector_pay_pct", num.percent("total_pay_000s", "total_income_000s"))


def benchmark_export(
    kpis: DataFrame, keys: Sequence[str] = ("financial_year", "sector", "trust_type")
) -> DataFrame:
    """Benchmarks in millions by year, sector and trust type."""

    def millions(column: str) -> Column:
        return F.round(num.in_units(F.sum(column), num.MILLIONS), 0)

    surplus = F.col("operating_surplus_000s")
    return (
        kpis.where("total_income_000s > 0 AND sector IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.count("org_code").alias("provider_count"),
            millions("total_income_000s").alias("total_income_m"),
            millions("total_expenditure_000s").alias("total_expenditure_m"),
            millions("operating_surplus_000s").alias("total_op_surplus_m"),
            num.rounded_mean("ebitda_margin_pct").alias("avg_ebitda_margin_pct"),
            num.rounded_mean("pay_pct_income").alias("avg_pay_pct_income"),
            num.rounded_mean("net_surplus_margin_pct").alias("avg_net_surplus_margin_pct"),
            num.count_if(surplus < 0).alias("deficit_count"),
            num.count_if(surplus >= 0).alias("surplus_count"),
        )
    )


def quantile_of_any_spread(
    frame: DataFrame, keys: Sequence[str], value: str, share: float, scale: int = 1, name: str = "quantile"
) -> DataFrame:
    """``exact_quantile`` per group for values of any spread, one row per group.

    ``exact_quantile`` holds a counter per distinct value in one aggregate. Here the counters
    are rows, range-partitioned on group and value: sums per partition tell in which one the
    wanted ranks lie, and only those partitions are numbered, so neither a group nor a value
    that many rows share comes into one task. The counters are checkpointed, as range bounds
    come from sampling. Null values count for nothing; a group without others has a null.
    Null keys are groups, and an empty frame gives no rows.
    """
    spark = frame.sparkSession
    scratch_root(spark)
    keys = list(keys)
    steps = F.round(F.col(value) * 10**scale, 0).cast("bigint")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counters = (
        frame.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), steps.alias("_step"))
        .groupBy(*(f"_k{i}" for i in range(len(keys))), "_step")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_rows", F.when(F.col("_step").isNotNull(), F.col("_rows")).otherwise(F.lit(0)))
    )
    group = [f"_k{i}" for i in range(len(keys))]
    spread = (
        counters.repartitionByRange(parts, *group, "_step")
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    at = (F.col("_all") - 1) * F.lit(float(share))
    held = (
        spread.groupBy(*group, "_part")
        .agg(F.sum("_rows").alias("_here"))
        .select(
            *group,
            "_part",
            "_here",
            F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_earlier"),
            F.sum("_here").over(whole).alias("_all"),
        )
        .withColumns({"_low": F.floor(at), "_high": F.ceil(at), "_at": at})
        .where("_all = 0 OR (_low < _earlier + _here AND _high >= _earlier)")
    )
    held = held.withColumnsRenamed({c: f"{c}_h" for c in [*group, "_part"]})
    same = F.col("_part") == F.col("_part_h")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_h"))
    running = Window.partitionBy(*group, "_part").orderBy("_step")
    placed = spread.join(held, same).withColumn("_until", F.sum("_rows").over(running) + F.col("_earlier"))

    def at_rank(rank: str) -> Column:
        inside = (F.col(rank) < F.col("_until")) & (F.col(rank) >= F.col("_until") - F.col("_rows"))
        return F.max(F.when(inside, F.col("_step")))

    ends = placed.groupBy(*group).agg(
        at_rank("_low").alias("_below"),
        at_rank("_high").alias("_above"),
        *(F.first(c).alias(c) for c in ("_low", "_high", "_at")),
    )
    between = (F.col("_high") - F.col("_at")) * F.col("_below") + (F.col("_at") - F.col("_low")) * F.col("_above")
    found = F.when(F.col("_low") == F.col("_high"), F.col("_below").cast("double")).otherwise(between)
    return ends.select(*(F.col(g).alias(k) for g, k in zip(group, keys)), found.alias(name))
