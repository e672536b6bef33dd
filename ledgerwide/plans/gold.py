"""Wide views per organisation and financial year.

``org_year_wide`` answers every view that mixes schedules (KPIs, scorecard,
measures) from a single scan and a single shuffle of the fact. The views are
projections of it; Catalyst prunes the aggregates a projection does not use. It
replaces joining separately pivoted views, which would scan and shuffle the fact
once per view.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import numeric as num
from ledgerwide.functions import status
from ledgerwide.operators import pivot
from ledgerwide.schemas import VIEW_KEY

INCOME_SUMMARY_LINES = {
    "SCI0100A": "patient_care_income_000s",
    "SCI0110A": "other_income_000s",
    "SCI0125A": "operating_expenses_000s",
    "SCI0140A": "operating_surplus_000s",
    "SCI0240": "net_surplus_000s",
}


def _summary_columns(coalesce_patient_income: bool = True) -> list[Column]:
    patient = F.col("patient_care_income_000s")
    first = F.coalesce(patient, F.lit(0)) if coalesce_patient_income else patient
    expenses = F.col("operating_expenses_000s")
    spent = F.coalesce(expenses, F.lit(0)) if coalesce_patient_income else expenses
    return [
        patient,
        F.col("other_income_000s"),
        (first + F.coalesce("other_income_000s", F.lit(0))).alias("total_income_000s"),
        F.abs(spent).alias("total_expenditure_000s"),
        F.col("operating_surplus_000s"),
        F.col("net_surplus_000s"),
    ]


def income_expenditure(
    fact: DataFrame, trusts: DataFrame, coalesce_patient_income: bool = True
) -> DataFrame:
    """V1. Summary of the income statement; expenses are stored negative, shown positive.

    ``coalesce_patient_income=False`` gives the stricter variant (V8), in which total
    income is null without patient income and expenditure null without expenses.
    """
    lines = pivot.sheet_view(fact, trusts, ref.SOCI, INCOME_SUMMARY_LINES)
    return lines.select(*VIEW_KEY, *_summary_columns(coalesce_patient_income))


def profit_and_loss(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    """V2. All lines of the income statement."""
    return pivot.sheet_view(fact, trusts, ref.SOCI, ref.PROFIT_AND_LOSS_LINES)


def expenditure_breakdown(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> DataFrame:
    """V3. Category totals plus single lines; codes outside the dictionary drop out."""
    known = codes.select("sub_code", "analytics_category")
    rows = fact.where(pivot.on_sheet(ref.EXPENDITURE)).join(known, "sub_code", "inner")
    totals = [
        pivot.category_total(category, column)
        for category, column in ref.EXPENDITURE_CATEGORIES.items()
    ]
    wide = pivot.per_org_year(rows, [*totals, *pivot.largest_each(ref.EXPENDITURE_LINES)])
    return pivot.with_organisation(wide, trusts)


def workforce(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    """V4. Staff cost, WTE by group and sickness."""
    return pivot.sheet_view(fact, trusts, ref.STAFF, ref.WORKFORCE_LINES)


def balance_sheet(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    """V5. All lines of the balance sheet, signs as stored."""
    return pivot.sheet_view(fact, trusts, ref.SOFP, ref.BALANCE_SHEET_LINES)


def _codes_in(lines: Mapping[str, str]) -> str:
    return "sub_code IN (" + ", ".join(f"'{code}'" for code in lines) + ")"


def org_year_wide(
    fact: DataFrame, trusts: DataFrame, codes: DataFrame, only_with_income: bool = False
) -> DataFrame:
    """Every summary, expenditure, workforce and scorecard column in one pass.

    ``only_with_income`` keeps organisation-years with income above zero. Those
    need an income row, so scans may then skip income-statement and staff codes
    that no column reads; without it all rows of both schedules stay, because
    their presence alone makes a view row.
    """
    soci, spend, staff = (pivot.on_sheet(s) for s in (ref.SOCI, ref.EXPENDITURE, ref.STAFF))
    extra = _codes_in(ref.SCORECARD_LINES)
    if only_with_income:
        summary, workforce_rows = _codes_in(INCOME_SUMMARY_LINES), _codes_in(ref.WORKFORCE_LINES)
        wanted = f"({soci} AND {summary}) OR {spend} OR ({staff} AND {workforce_rows}) OR {extra}"
    else:
        wanted = f"{soci} OR {spend} OR {staff} OR {extra}"

    known = codes.select(
        F.col("sub_code"), "analytics_category", F.lit(True).alias("in_dictionary")
    )
    rows = fact.where(wanted).join(known, "sub_code", "left")
    spend_known = f"{spend} AND in_dictionary"
    columns = [
        pivot.any_row(soci, "has_summary"),
        pivot.any_row(spend_known, "has_spend"),
        pivot.any_row(staff, "has_staff"),
        *pivot.largest_each(INCOME_SUMMARY_LINES, soci),
        *(
            pivot.category_total(category, column, spend_known)
            for category, column in ref.EXPENDITURE_CATEGORIES.items()
        ),
        *pivot.largest_each(ref.EXPENDITURE_LINES, spend_known, "ex_"),
        *pivot.largest_each(ref.WORKFORCE_LINES, staff),
        *pivot.largest_each(ref.SCORECARD_LINES, None, "sc_"),
    ]
    wide = pivot.with_organisation(pivot.per_org_year(rows, columns), trusts)
    kept = [c for c in wide.columns if c not in (*VIEW_KEY, *INCOME_SUMMARY_LINES.values())]
    wide = wide.select(*VIEW_KEY, *_summary_columns(), *kept)
    if only_with_income:
        wide = wide.where(F.col("has_summary") & (F.col("total_income_000s") > 0))
    return wide


def _ebitda() -> Column:
    return F.col("operating_surplus_000s") + F.coalesce("depreciation_amort_000s", F.lit(0))


def _with_ratios(wide: DataFrame) -> DataFrame:
    """KPI columns. Status uses the margin of the whole EBITDA, not of its depreciation part."""
    income = "total_income_000s"
    margin = num.ratio(_ebitda(), income, 100.0)
    surplus = num.ratio("net_surplus_000s", income, 100.0)
    return wide.select(
        "*",
        _ebitda().alias("ebitda_000s"),
        F.round(margin, 1).alias("ebitda_margin_pct"),
        num.percent("pay_000s", income).alias("pay_pct_income"),
        F.round(num.ratio("ex_staff_cost_000s", "total_wte"), 1).alias("cost_per_wte_000s"),
        F.round(surplus, 1).alias("net_surplus_margin_pct"),
        F.when(F.col("operating_surplus_000s") < 0, 1).otherwise(0).alias("is_deficit"),
        status.EBITDA_BANDS.status(margin, when_null="Red").alias("ebitda_rag"),
        status.SURPLUS_BANDS.status(surplus, when_null="Red").alias("surplus_rag"),
    )


KPI_COLUMNS = [
    "total_income_000s", "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
    "pay_000s", "non_pay_000s", "depreciation_amort_000s",
    ("ex_staff_cost_000s", "staff_cost_000s"),
    ("ex_drugs_cost_000s", "drugs_cost_000s"),
    ("ex_clinical_negligence_000s", "clinical_negligence_000s"),
    "total_wte", "medical_wte", "nursing_wte", "avg_days_lost_per_wte",
    "ebitda_000s", "ebitda_margin_pct", "pay_pct_income", "cost_per_wte_000s",
    "net_surplus_margin_pct", "is_deficit", "ebitda_rag", "surplus_rag",
]

SCORECARD_COLUMNS = [
    "total_income_000s", "patient_care_income_000s", "other_income_000s",
    *(("sc_" + c, c) for c in list(ref.SCORECARD_LINES.values())[:8]),
    "total_expenditure_000s", "pay_000s", "non_pay_000s", "depreciation_amort_000s",
    ("ex_drugs_cost_000s", "drugs_cost_000s"),
    ("ex_staff_cost_000s", "staff_cost_000s"),
    *(("sc_" + c, c) for c in list(ref.SCORECARD_LINES.values())[8:13]),
    "operating_surplus_000s", "net_surplus_000s", "ebitda_000s",
    *(("sc_" + c, c) for c in list(ref.SCORECARD_LINES.values())[13:]),
    "total_wte", "total_staff_cost_000s", "gross_staff_cost_000s",
    "ebitda_margin_pct", "pay_pct_income", "cost_per_wte_000s", "net_surplus_margin_pct",
    "is_deficit",
]


def _pick(columns) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else F.col(c[0]).alias(c[1]) for c in columns]


def kpis(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> DataFrame:
    """V6. KPIs of organisation-years with income. A missing margin is Red here."""
    return kpis_of(org_year_wide(fact, trusts, codes, only_with_income=True))


# Views that mix or repeat schedules are also projections of one ``org_year_wide`` frame, which
# a caller who needs several of them stores once.


def kpis_of(wide: DataFrame) -> DataFrame:
    """V6 from ``org_year_wide``."""
    with_income = wide.where(F.col("has_summary") & (F.col("total_income_000s") > 0))
    return _with_ratios(with_income).select(*VIEW_KEY, *_pick(KPI_COLUMNS))


def income_expenditure_of(wide: DataFrame) -> DataFrame:
    """V1 from ``org_year_wide``."""
    columns = (
        "patient_care_income_000s", "other_income_000s", "total_income_000s",
        "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
    )
    return wide.where("has_summary").select(*VIEW_KEY, *columns)


def expenditure_breakdown_of(wide: DataFrame) -> DataFrame:
    """V3 from ``org_year_wide``."""
    lines = [F.col(f"ex_{c}").alias(c) for c in ref.EXPENDITURE_LINES.values()]
    return wide.where("has_spend").select(*VIEW_KEY, *ref.EXPENDITURE_CATEGORIES.values(), *lines)


def workforce_of(wide: DataFrame) -> DataFrame:
    """V4 from ``org_year_wide``."""
    return wide.where("has_staff").select(*VIEW_KEY, *ref.WORKFORCE_LINES.values())


def scorecard(
    fact: DataFrame,
    trusts: DataFrame,
    codes: DataFrame,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """V7. KPIs, components and flags in one wide row.

    Status differs from the KPI view: EBITDA is graded on the rounded margin and
    the surplus on its sign, and a missing value is Green in both. ``extra`` adds
    further columns of ``org_year_wide`` (the workforce groups, for example).
    """
    return scorecard_of(org_year_wide(fact, trusts, codes, only_with_income=True), extra)


def scorecard_of(wide: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """V7 from ``org_year_wide``."""
    with_income = wide.where(F.col("has_summary") & (F.col("total_income_000s") > 0))
    return _with_ratios(with_income).select(
        *VIEW_KEY,
        *_pick(SCORECARD_COLUMNS),
        status.EBITDA_BANDS.status("ebitda_margin_pct", when_null="Green").alias("ebitda_rag"),
        status.sign_status("net_surplus_000s").alias("surplus_rag"),
        *extra,
    )


def measure_base(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> DataFrame:
    """All organisation-years of all views, KPI columns null where there is no KPI row."""
    wide = org_year_wide(fact, trusts, codes)
    has_kpi = F.col("has_summary") & (F.col("total_income_000s") > 0)
    return wide.select(
        *VIEW_KEY,
        "has_summary", "has_spend", "has_staff", has_kpi.alias("has_kpi"),
        *(
            F.when(F.col("has_summary"), F.col(c)).alias(c)
            for c in (
                "patient_care_income_000s", "other_income_000s", "total_income_000s",
                "total_expenditure_000s", "operating_surplus_000s", "net_surplus_000s",
            )
        ),
        "pay_000s", "non_pay_000s", "depreciation_amort_000s",
        F.col("ex_drugs_cost_000s").alias("drugs_cost_000s"),
        *ref.WORKFORCE_LINES.values(),
        F.when(has_kpi, _ebitda()).alias("kpi_ebitda_000s"),
        F.when(has_kpi, F.col("total_income_000s")).alias("kpi_income_000s"),
        F.when(has_kpi, F.col("pay_000s")).alias("kpi_pay_000s"),
        F.when(has_kpi, F.col("operating_surplus_000s")).alias("kpi_surplus_000s"),
        F.when(has_kpi, num.percent(_ebitda(), "total_income_000s")).alias("ebitda_margin_pct"),
    )


def views(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> dict[str, DataFrame]:
    """The seven views by name."""
    return {
        "income_expenditure": income_expenditure(fact, trusts),
        "profit_and_loss": profit_and_loss(fact, trusts),
        "expenditure_breakdown": expenditure_breakdown(fact, trusts, codes),
        "workforce": workforce(fact, trusts),
        "balance_sheet": balance_sheet(fact, trusts),
        "kpis": kpis(fact, trusts, codes),
        "scorecard": scorecard(fact, trusts, codes),
    }


def views_of(wide: DataFrame, fact: DataFrame, trusts: DataFrame) -> dict[str, DataFrame]:
    """The seven views, five of them from ``org_year_wide``, which the caller has stored."""
    return {
        "income_expenditure": income_expenditure_of(wide),
        "profit_and_loss": profit_and_loss(fact, trusts),
        "expenditure_breakdown": expenditure_breakdown_of(wide),
        "workforce": workforce_of(wide),
        "balance_sheet": balance_sheet(fact, trusts),
        "kpis": kpis_of(wide),
        "scorecard": scorecard_of(wide),
    }


def register_views(fact: DataFrame, trusts: DataFrame, codes: DataFrame) -> list[str]:
    """Name the seven views for SQL users."""
    named = views(fact, trusts, codes)
    for name, frame in named.items():
        frame.createOrReplaceTempView(name)
    return list(named)


def write_views(fact: DataFrame, trusts: DataFrame, codes: DataFrame, folder: str) -> list[str]:
    """Store the views by year, for analyses that would otherwise recompute them."""
    named = views(fact, trusts, codes)
    for name, frame in named.items():
        out = f"{folder.rstrip('/')}/{name}"
        frame.write.mode("overwrite").partitionBy("financial_year").parquet(out)
    return list(named)
