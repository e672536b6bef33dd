"""Flat datasets for a dashboard: what is exported, in which order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import fiscal
from ledgerwide.operators import benchmarks, detail, enrich
from ledgerwide.plans import gold
from ledgerwide.schemas import TRUST_SCHEMA, VIEW_KEY
from ledgerwide.session import drop_scratch, scratch_path
from ledgerwide.sources.sinks import write_csv

ORG_YEAR_ORDER = ["financial_year", "org_code"]
WRITERS = 4  # datasets written at the same time
DETAIL_ORDER = ["financial_year", "org_code", "sub_code"]


@dataclass(frozen=True)
class Warehouse:
    """The tables every export reads.

    ``wide`` and ``enriched`` are what several datasets share, stored; without them each
    dataset computes its own part from the fact.
    """

    fact: DataFrame
    trusts: DataFrame
    codes: DataFrame
    years: DataFrame
    enriched: DataFrame | None = None
    wide: DataFrame | None = None

    def income_expenditure(self) -> DataFrame:
        return gold.income_expenditure(self.fact, self.trusts) if self.wide is None else gold.income_expenditure_of(self.wide)

    def expenditure_breakdown(self) -> DataFrame:
        if self.wide is None:
            return gold.expenditure_breakdown(self.fact, self.trusts, self.codes)
        return gold.expenditure_breakdown_of(self.wide)

    def workforce(self) -> DataFrame:
        return gold.workforce(self.fact, self.trusts) if self.wide is None else gold.workforce_of(self.wide)

    def kpis(self) -> DataFrame:
        return gold.kpis(self.fact, self.trusts, self.codes) if self.wide is None else gold.kpis_of(self.wide)


@dataclass(frozen=True)
class Export:
    build: Callable[[Warehouse], DataFrame]
    order: list[str]

    def frame(self, warehouse: Warehouse) -> DataFrame:
        return self.build(warehouse).orderBy(*self.order)


def whole(columns: list[str]) -> list:
    """Money and counts as BIGINT."""
    return [F.col(c).cast("bigint").alias(c) for c in columns]


def trusts_export(w: Warehouse) -> DataFrame:
    return w.trusts.select(*(field.strip().split()[0] for field in TRUST_SCHEMA.split(",")))


def years_export(w: Warehouse) -> DataFrame:
    return w.years.select(
        "financial_year", "start_date", "end_date", "year_label_short", "is_complete"
    )


def income_summary_export(w: Warehouse) -> DataFrame:
    columns = [
        "patient_care_income_000s", "other_income_000s", "total_income_000s",
        "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
    ]
    return w.income_expenditure().select(*VIEW_KEY, *whole(columns))


def expenditure_export(w: Warehouse) -> DataFrame:
    columns = [
        "pay_000s", "non_pay_000s", "depreciation_amort_000s", "drugs_cost_000s",
        "staff_cost_000s", "total_expenditure_000s",
    ]
    view = w.expenditure_breakdown()
    return view.select(*VIEW_KEY, *whole(columns))


def workforce_export(w: Warehouse) -> DataFrame:
    columns = [
        "total_staff_cost_000s", "gross_staff_cost_000s", "total_wte", "medical_wte",
        "nursing_wte", "admin_estates_wte", "scientific_tech_wte",
    ]
    view = w.workforce().where("total_staff_cost_000s IS NOT NULL")
    return view.select(*VIEW_KEY, *whole(columns), "avg_days_lost_per_wte")


def kpi_export(w: Warehouse) -> DataFrame:
    columns = [
        "total_income_000s", "total_expenditure_000s", "operating_surplus_000s",
        "net_surplus_000s", "pay_000s", "drugs_cost_000s", "depreciation_amort_000s",
        "ebitda_000s",
    ]
    ratios = ["ebitda_margin_pct", "pay_pct_income", "cost_per_wte_000s", "net_surplus_margin_pct"]
    view = w.kpis().where("total_income_000s > 0")
    return view.select(*VIEW_KEY, *whole(columns), *ratios, "total_wte")


def income_items_export(w: Warehouse) -> DataFrame:
    return detail.line_items(w.fact, w.trusts, w.codes, [ref.INCOME_1, ref.INCOME_2])


def expenditure_items_export(w: Warehouse) -> DataFrame:
    return detail.line_items(w.fact, w.trusts, w.codes, [ref.EXPENDITURE])


def profit_and_loss_export(w: Warehouse) -> DataFrame:
    columns = list(ref.PROFIT_AND_LOSS_LINES.values())
    return gold.profit_and_loss(w.fact, w.trusts).select(*VIEW_KEY, *whole(columns))


def balance_sheet_export(w: Warehouse) -> DataFrame:
    columns = list(ref.BALANCE_SHEET_LINES.values())
    return gold.balance_sheet(w.fact, w.trusts).select(*VIEW_KEY, *whole(columns))


def benchmark_export(w: Warehouse) -> DataFrame:
    return benchmarks.benchmark_export(w.kpis())


EXPORTS: dict[str, Export] = {
    "dim_trust": Export(trusts_export, ["organisation_name", "org_code"]),
    "dim_financial_year": Export(years_export, ["financial_year"]),
    "ie_summary": Export(income_summary_export, ORG_YEAR_ORDER),
    "expenditure_breakdown": Export(expenditure_export, ORG_YEAR_ORDER),
    "workforce": Export(workforce_export, ORG_YEAR_ORDER),
    "kpis": Export(kpi_export, ORG_YEAR_ORDER),
    "income_detail": Export(income_items_export, DETAIL_ORDER),
    "expenditure_detail": Export(expenditure_items_export, DETAIL_ORDER),
    "profit_and_loss": Export(profit_and_loss_export, ORG_YEAR_ORDER),
    "balance_sheet": Export(balance_sheet_export, ORG_YEAR_ORDER),
    "sector_benchmarks": Export(benchmark_export, ["financial_year", "sector", "trust_type"]),
}


def enriched_scorecard(w: Warehouse) -> DataFrame:
    """Scorecard with workforce groups, flags, income mix and year-on-year change."""
    if w.enriched is not None:
        return w.enriched
    card = gold.scorecard(w.fact, w.trusts, w.codes, extra=("medical_wte", "nursing_wte"))
    return enrich.enriched(card)


def _from_card(columns: list[str]) -> Export:
    return Export(lambda w: enriched_scorecard(w).select(*columns), ORG_YEAR_ORDER)


# The enriched run writes some of the same names with other columns: keep it in its own folder.
ENRICHED: dict[str, Export] = {
    "kpis": _from_card(enrich.KPI_EXPORT),
    "ie_summary": _from_card(enrich.INCOME_EXPORT),
    "expenditure_breakdown": _from_card(enrich.EXPENDITURE_EXPORT),
    "workforce": _from_card(enrich.WORKFORCE_EXPORT),
    "sector_benchmarks": Export(
        lambda w: benchmarks.sector_benchmarks(enriched_scorecard(w)), ["financial_year", "sector"]
    ),
    "income_detail": Export(
        lambda w: detail.income_detail(w.fact, w.trusts, w.codes),
        ["financial_year", "org_code", "worksheet_name", "sub_code"],
    ),
    "expenditure_detail": Export(
        lambda w: detail.expenditure_detail(w.fact, w.trusts, w.codes), DETAIL_ORDER
    ),
    "dim_trust": Export(lambda w: w.trusts, ["org_code"]),
    "dim_financial_year": Export(lambda w: w.years, ["financial_year"]),
}


def warehouse_of(
    spark: SparkSession, fact: DataFrame, trusts: DataFrame, codes: DataFrame | None = None
) -> Warehouse:
    return Warehouse(
        fact,
        trusts,
        ref.code_dimension(spark) if codes is None else codes,
        fiscal.year_dimension(spark, ref.FIRST_YEAR, ref.LAST_YEAR),
    )


def write_exports(
    warehouse: Warehouse, folder: str, exports: Mapping[str, Export] = EXPORTS
) -> dict[str, int]:
    """Write each dataset to ``folder/<name>.csv`` and return the rows written.

    The frame that the summary, breakdown, workforce, KPI and benchmark datasets share is
    pivoted once and stored by year while they are written. Datasets do not depend on each
    other, so some are written at a time and fill the cluster together.
    """
    spark = warehouse.fact.sparkSession
    shared = None
    if warehouse.wide is None and warehouse.enriched is None:
        shared = scratch_path(spark, "wide")
        wide = gold.org_year_wide(warehouse.fact, warehouse.trusts, warehouse.codes)
        wide.write.partitionBy("financial_year").parquet(shared)
        warehouse = replace(warehouse, wide=spark.read.schema(wide.schema).parquet(shared))

    def write(item: tuple[str, Export]) -> tuple[str, int]:
        name, export = item
        return name, write_csv(export.frame(warehouse), f"{folder.rstrip('/')}/{name}.csv")

    try:
        with ThreadPoolExecutor(WRITERS) as pool:
            return dict(pool.map(write, exports.items()))
    finally:
        if shared:
            drop_scratch(spark, shared)


def write_enriched(warehouse: Warehouse, folder: str) -> dict[str, int]:
    """Build the enriched scorecard once as Parquet, then write the datasets from it."""
    spark = warehouse.fact.sparkSession
    stored = f"{folder.rstrip('/')}/enriched_scorecard.parquet"
    enriched_scorecard(warehouse).write.mode("overwrite").parquet(stored)
    return write_exports(replace(warehouse, enriched=spark.read.parquet(stored)), folder, ENRICHED)
