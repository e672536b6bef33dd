"""Dashboard measures as grouped aggregates.

A filter context is a ``where`` plus a ``groupBy``: ``measures(base, keys)`` gives
all 51 measures for every combination of ``keys``. ``base`` is
``plans.gold.measure_base``. Unused measures cost nothing: selecting a few lets
Catalyst drop the aggregates of the others.

A missing value is null. Where a dashboard subtracts a missing value it counts as
zero, so differences use ``blank_minus``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide.functions import fiscal, status, text
from ledgerwide.functions import numeric as num
from ledgerwide.operators import yoy

# Years the dashboard maps to a prior year.
MAPPED_YEARS = ["2021/22", "2022/23", "2023/24"]

# Measure -> summed column, shown in millions.
MILLION_SUMS = {
    "total_income_m": "total_income_000s",
    "patient_care_income_m": "patient_care_income_000s",
    "other_income_m": "other_income_000s",
    "total_expenditure_m": "total_expenditure_000s",
    "operating_surplus_m": "operating_surplus_000s",
    "net_surplus_m": "net_surplus_000s",
    "total_pay_m": "pay_000s",
    "total_non_pay_m": "non_pay_000s",
    "depreciation_amort_m": "depreciation_amort_000s",
    "drugs_cost_m": "drugs_cost_000s",
    "ebitda_m": "kpi_ebitda_000s",
    "total_staff_cost_m": "total_staff_cost_000s",
}

# Measure -> summed column, shown as is.
PLAIN_SUMS = {
    "total_wte": "total_wte",
    "medical_wte": "medical_wte",
    "nursing_wte": "nursing_wte",
    "admin_estates_wte": "admin_estates_wte",
    "scientific_tech_wte": "scientific_tech_wte",
}

# Measure -> (top, bottom, scale) over sums.
RATIOS = {
    "ebitda_margin_pct": ("kpi_ebitda_000s", "kpi_income_000s", 100.0),
    "pay_pct_of_income": ("kpi_pay_000s", "kpi_income_000s", 100.0),
    "net_surplus_margin_pct": ("net_surplus_000s", "total_income_000s", 100.0),
    "avg_cost_per_wte_000s": ("total_staff_cost_000s", "total_wte", 1.0),
    "medical_pct_of_wte": ("medical_wte", "total_wte", 100.0),
    "nursing_pct_of_wte": ("nursing_wte", "total_wte", 100.0),
}

STATUS = {
    "ebitda_rag": ("ebitda_margin_pct", status.EBITDA_BANDS),
    "surplus_rag": ("net_surplus_margin_pct", status.SURPLUS_BANDS),
    "pay_rag": ("pay_pct_of_income", status.PAY_BANDS),
}


def _distinct_trusts(keys: Sequence[str]) -> Column:
    """Within one year every row is another organisation; otherwise count them distinctly."""
    org = F.when(F.col("has_kpi"), F.col("org_code"))
    return F.count(org) if "financial_year" in keys else F.count_distinct(org)


def _selected(column: str, keys: Sequence[str], otherwise: str) -> Column:
    """The only value of a column in the group, or a fixed text."""
    if column in keys:
        return F.coalesce(F.col(column), F.lit(otherwise))
    low, high = F.min(column), F.max(column)
    complete = F.count(column) == F.count(F.lit(1))
    return F.when((low == high) & complete, low).otherwise(otherwise)


def base_measures(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums, counts and selections per key combination: the only shuffle."""
    sums = sorted(
        {*MILLION_SUMS.values(), *PLAIN_SUMS.values()}
        | {c for top, bottom, _ in RATIOS.values() for c in (top, bottom)}
    )
    selections = {
        "selected_year": ("financial_year", "All Years"),
        "selected_sector": ("sector", "All Sectors"),
        "selected_region": ("region", "All Regions"),
    }
    grouped = base.groupBy(*keys).agg(
        *(F.sum(c).alias(f"_{c}") for c in sums),
        num.count_if(F.col("kpi_surplus_000s") < 0).alias("deficit_trusts"),
        num.count_if(F.col("kpi_surplus_000s") >= 0).alias("surplus_trusts"),
        _distinct_trusts(keys).alias("total_trusts"),
        *(
            _selected(column, keys, text_).alias(name)
            for name, (column, text_) in selections.items()
            if column not in keys
        ),
    )
    return grouped.select(
        *keys,
        *(num.in_units(f"_{c}", num.MILLIONS).alias(name) for name, c in MILLION_SUMS.items()),
        *(F.col(f"_{c}").alias(name) for name, c in PLAIN_SUMS.items() if name not in keys),
        *(num.ratio(f"_{a}", f"_{b}", k).alias(name) for name, (a, b, k) in RATIOS.items()),
        "deficit_trusts",
        "surplus_trusts",
        "total_trusts",
        num.ratio("deficit_trusts", "total_trusts", 100.0).alias("deficit_pct"),
        *(
            (_selected(column, keys, text_) if column in keys else F.col(name)).alias(name)
            for name, (column, text_) in selections.items()
        ),
    )


def prior_year_label(selected_year: str | Column, mapped: Sequence[str] | None = MAPPED_YEARS) -> Column:
    """The year before, for mapped years only; any single year when ``mapped`` is None."""
    year = text.col(selected_year)
    known = year.rlike(r"^\d{4}/\d{2}$") if mapped is None else year.isin(list(mapped))
    return F.when(known, fiscal.prior_label(F.when(known, year)))


def _with_prior_year(df: DataFrame, keys: Sequence[str], mapped: Sequence[str] | None) -> DataFrame:
    """Values of the year before, by a range frame over the few rows per key combination."""
    sources = {
        "prior_year_income_m": "total_income_m",
        "prior_year_ebitda_margin_pct": "ebitda_margin_pct",
        "prior_year_pay_pct": "pay_pct_of_income",
        "prior_year_deficit_trusts": "deficit_trusts",
    }
    df = df.withColumn("prior_year", prior_year_label("selected_year", mapped))
    if "financial_year" in keys:
        others = [k for k in keys if k != "financial_year"]
        known = F.col("prior_year").isNotNull()
        priors = {n: F.when(known, yoy.prior_year(c, others)) for n, c in sources.items()}
    else:
        types = dict(df.dtypes)
        priors = {n: F.lit(None).cast(types[c]) for n, c in sources.items()}
    df = df.withColumns(priors)
    income, before = F.col("total_income_m"), F.col("prior_year_income_m")
    return df.withColumns(
        {
            "income_yoy_growth_pct": F.when(
                before.isNotNull(), num.ratio(num.blank_minus(income, before), before, 100.0)
            ),
            "ebitda_margin_yoy_pp": num.blank_minus(
                F.col("ebitda_margin_pct"), F.col("prior_year_ebitda_margin_pct")
            ),
            "pay_pct_yoy_pp": num.blank_minus(
                F.col("pay_pct_of_income"), F.col("prior_year_pay_pct")
            ),
            "deficit_trusts_yoy_change": num.blank_minus(
                F.col("deficit_trusts"), F.col("prior_year_deficit_trusts")
            ),
        }
    )


def _one_decimal(value: Column) -> Column:
    return F.coalesce(text.plain_decimal(F.round(value, 1)), F.lit(""))


def _with_text(df: DataFrame) -> DataFrame:
    surplus = F.col("operating_surplus_m")
    amount = F.concat(F.lit("£"), _one_decimal(F.abs(surplus)))
    # A missing surplus compares as zero, hence "surplus".
    is_deficit = F.coalesce(surplus < 0, F.lit(False))
    df = df.withColumns(
        {name: bands.status(column, when_null="Grey") for name, (column, bands) in STATUS.items()}
    )
    return df.withColumns(
        {
            **{f"{name}_colour": status.rag_colour(name) for name in STATUS},
            "page_title": F.concat(
                F.lit("Income & Expenditure - "), "selected_year", F.lit(" | "), "selected_sector"
            ),
            "surplus_label": F.concat(
                amount, F.when(is_deficit, "m deficit").otherwise("m surplus")
            ),
            "ebitda_label": F.concat(_one_decimal(F.col("ebitda_margin_pct")), F.lit("% EBITDA margin")),
            "deficit_count_label": F.concat(
                F.col("deficit_trusts").cast("string"),
                F.lit(" of "),
                F.col("total_trusts").cast("string"),
                F.lit(" trusts in deficit"),
            ),
        }
    )


def sector_benchmark(base: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean over sectors of each sector's mean benchmark margin.

    The inner mean is over the exported benchmark rows (year, sector, trust type),
    whose margins are already rounded to one decimal.
    """
    rows = (
        base.where("has_kpi AND sector IS NOT NULL")
        .groupBy("financial_year", "sector", "trust_type")
        .agg(num.rounded_mean("ebitda_margin_pct").alias("benchmark"))
    )
    inner = [*dict.fromkeys([*by, "sector"])]
    per_sector = rows.groupBy(*inner).agg(num.exact_mean("benchmark").alias("benchmark"))
    return per_sector.groupBy(*by).agg(
        num.exact_mean("benchmark", scale=9).alias("sector_benchmark_ebitda_pct")
    )


def measures(
    base: DataFrame,
    keys: Sequence[str] = ("financial_year",),
    mapped_years: Sequence[str] | None = MAPPED_YEARS,
    with_benchmark: bool = True,
) -> DataFrame:
    """Every measure for every key combination.

    Prior-year measures need ``financial_year`` among the keys; otherwise no single
    year is selected and they are null, as on a dashboard. Filter ``base`` by sector
    or region as wished, but filter years on the result, so that prior years are there.
    """
    keys = list(keys)
    table = _with_text(_with_prior_year(base_measures(base, keys), keys, mapped_years))
    if not with_benchmark:
        return table
    by = [k for k in keys if k in ("financial_year", "sector", "trust_type")]
    benchmark = sector_benchmark(base, by)
    if by:
        # One row per year, sector and type at most.
        renamed = benchmark.select(*(F.col(k).alias(f"_{k}") for k in by), "sector_benchmark_ebitda_pct")
        same = F.lit(True)
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        table = table.join(renamed, same, "left").drop(*(f"_{k}" for k in by))
    else:
        table = table.withColumn("sector_benchmark_ebitda_pct", benchmark.scalar())
    gap = num.blank_minus(F.col("ebitda_margin_pct"), F.col("sector_benchmark_ebitda_pct"))
    return table.withColumn("ebitda_vs_benchmark_pp", gap)


def measure(
    base: DataFrame,
    names: str | Sequence[str],
    keys: Sequence[str] = ("financial_year",),
    filters: Mapping[str, object] | Column | None = None,
    mapped_years: Sequence[str] | None = MAPPED_YEARS,
) -> DataFrame:
    """Chosen measures under a filter; year filters apply after prior years are found."""
    names = [names] if isinstance(names, str) else list(names)
    after = None
    if isinstance(filters, Mapping):
        for column, wanted in filters.items():
            values = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
            condition = F.col(column).isin(values)
            if column == "financial_year" and column in keys:
                after = condition
            else:
                base = base.where(condition)
    elif filters is not None:
        base = base.where(filters)
    benchmarked = bool({"sector_benchmark_ebitda_pct", "ebitda_vs_benchmark_pp"} & set(names))
    result = measures(base, keys, mapped_years, benchmarked)
    if after is not None:
        result = result.where(after)
    return result.select(*keys, *(n for n in names if n not in keys))


# --- dashboard datasets ------------------------------------------------------------


def surplus_bridge(base: DataFrame) -> DataFrame:
    """Income, expenditure and surplus as steps per year, in millions."""
    sums = base.groupBy("financial_year").agg(
        F.sum("total_income_000s").alias("i"),
        F.sum("total_expenditure_000s").alias("e"),
        F.sum("operating_surplus_000s").alias("s"),
    )
    step = F.stack(
        F.lit(3),
        F.lit(1), F.lit("Income"), num.in_units("i", num.MILLIONS),
        F.lit(2), F.lit("Expenditure"), -num.in_units("e", num.MILLIONS),
        F.lit(3), F.lit("Surplus"), num.in_units("s", num.MILLIONS),
    ).alias("step_no", "step", "amount_m")
    return sums.select("financial_year", step)


def deficit_split(base: DataFrame) -> DataFrame:
    """Organisations in deficit and in surplus per year, in long form."""
    surplus = F.col("kpi_surplus_000s")
    return (
        base.where("has_kpi")
        .select(
            "financial_year",
            F.when(surplus < 0, "Deficit").when(surplus >= 0, "Surplus").alias("result"),
        )
        .where("result IS NOT NULL")
        .groupBy("financial_year", "result")
        .agg(F.count("*").alias("trusts"))
    )


def wte_by_sector(base: DataFrame) -> DataFrame:
    return (
        base.where("sector IS NOT NULL AND has_staff")
        .groupBy("financial_year", "sector")
        .agg(F.sum("total_wte").alias("total_wte"))
    )
