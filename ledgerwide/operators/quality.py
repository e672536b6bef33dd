"""Data-quality checks with severities.

Checks on the same table share one aggregate. Every check is a row
``check_name, severity, passed, detail``; ``run_checks`` turns a failing job into
a CRITICAL row instead of stopping the run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import numeric as num
from ledgerwide.functions import text
from ledgerwide.operators.resolve import orphan_count, unmatched_names
from ledgerwide.schemas import FACT_KEY, ORG_YEAR

CRITICAL, WARNING = "CRITICAL", "WARNING"
REPORT_SCHEMA = "check_name string, severity string, passed boolean, detail string, run_ts string"


@dataclass(frozen=True)
class Expectations:
    """What the published data of three years should show."""

    fact_rows_min: int = 2_000_000
    trusts_min: int = 200
    years: Sequence[str] = field(default_factory=lambda: list(ref.LOADED_YEARS))
    year: str = "2023/24"
    income_bn: tuple[float, float] = (125, 135)
    deficits: tuple[int, int] = (100, 140)
    ebitda_pct: tuple[float, float] = (2.0, 6.0)
    pay_sector: str = "Acute"
    pay_pct: tuple[float, float] = (60, 75)
    balance_tolerance_000s: int = 1000
    wte_max: int = 50_000


Check = tuple[str, str, Column, Column]


def _as_rows(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(severity).alias("severity"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                detail.alias("detail"),
            )
            for name, severity, passed, detail in checks
        )
    )
    return one_row.select(F.inline(rows))


def _say(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _whole(column: str) -> Column:
    return F.format_number(F.col(column), 0)


# --- before a load ---------------------------------------------------------------


def batch_problems(staged: DataFrame) -> DataFrame:
    """Nulls in the critical columns and rows repeating a key, in one row.

    Repeats are counted from group sizes, so a key with many copies is combined on
    the map side and never gathered.
    """
    critical = ["organisation_name", "sub_code", "total", "financial_year"]
    per_key = staged.groupBy("organisation_name", "financial_year", "trust_type", "main_code", "sub_code").agg(
        F.count("*").alias("n"), F.count("total").alias("with_total")
    )
    nulls = [
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("n"))), F.lit(0)).alias(f"null_{c}")
        for c in critical
        if c != "total"
    ]
    return per_key.agg(
        *nulls,
        F.coalesce(F.sum(F.col("n") - F.col("with_total")), F.lit(0)).alias("null_total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_rows"),
    )


def assert_loadable(staged: DataFrame, providers: DataFrame) -> dict[str, int]:
    """Raise on nulls in critical columns; return the warning counts otherwise."""
    found = batch_problems(staged).first().asDict()
    nulls = {k: v for k, v in found.items() if k.startswith("null_") and v}
    if nulls:
        raise ValueError(f"critical nulls: {nulls}")
    return {
        "repeated_rows": found["repeated_rows"] or 0,
        "unmatched_names": unmatched_names(staged, providers).count(),
    }


# --- after a load ----------------------------------------------------------------


def fact_state(fact: DataFrame, *more: str) -> DataFrame:
    """Rows and repeated keys of every organisation-year: all that the checks of a fact ask of it.

    A key lies in one organisation-year, so states of disjoint organisation-years add up to
    the state of the whole. ``more`` names further columns that are constant in one.
    """
    per_key = fact.groupBy(*FACT_KEY, *more).agg(F.count("*").alias("copies"))
    return per_key.groupBy(*ORG_YEAR, *more).agg(
        F.sum("copies").alias("n_rows"), num.count_if(F.col("copies") > 1).alias("n_repeated")
    )


def fact_checks(fact: DataFrame, expect: Expectations) -> DataFrame:
    """Row count, year coverage and blank codes from one pass over the fact."""
    return _state_checks(fact.select(*ORG_YEAR, F.lit(1).alias("n_rows")), expect)


def state_checks(state: DataFrame, trusts: DataFrame, expect: Expectations) -> DataFrame:
    """All checks of the fact from its ``fact_state``: repeated keys and orphans too."""
    known = trusts.select("org_code", F.lit(True).alias("_known")).dropDuplicates(["org_code"])
    lone = F.count_distinct(F.when(F.col("_known").isNull(), F.col("org_code")))
    more = [F.coalesce(F.sum("n_repeated"), F.lit(0)).alias("repeated"), lone.alias("orphans")]
    return _state_checks(state.join(known, "org_code", "left"), expect, more, [_duplicate_row("repeated"), _orphan_row()])


def _state_checks(
    state: DataFrame, expect: Expectations, more: Sequence[Column] = (), also: Sequence[Check] = ()
) -> DataFrame:
    year = F.col("financial_year")
    blank = F.col("org_code").isNull() | (F.trim("org_code") == "")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0))

    summary = state.agg(
        rows_where(F.lit(True)).alias("n"),
        rows_where(blank).alias("blank"),
        *(num.count_if(year == y).alias(f"y{i}") for i, y in enumerate(expect.years)),
        *more,
    )
    checks: list[Check] = [
        (
            "fact row count",
            CRITICAL,
            F.col("n") >= expect.fact_rows_min,
            _say(_whole("n"), f" rows (expected ≥ {expect.fact_rows_min:,})"),
        )
    ]
    for i, y in enumerate(expect.years):
        found = F.col(f"y{i}") > 0
        checks.append(
            (
                f"year coverage: {y}",
                CRITICAL,
                found,
                _say(F.when(found, "found").otherwise("MISSING"), " in fact"),
            )
        )
    checks.append(
        (
            "no null org_codes in fact",
            CRITICAL,
            F.col("blank") == 0,
            _say(F.col("blank"), " rows carry no organisation code"),
        )
    )
    return _as_rows(summary, [*checks, *also])


def trust_count_check(trusts: DataFrame, expect: Expectations) -> DataFrame:
    summary = trusts.agg(F.count("*").alias("n"))
    return _as_rows(
        summary,
        [
            (
                "dim_trust row count",
                CRITICAL,
                F.col("n") >= expect.trusts_min,
                _say(F.col("n"), f" trusts (expected ≥ {expect.trusts_min})"),
            )
        ],
    )


def _copies(fact: DataFrame, key: Sequence[str] = tuple(FACT_KEY)) -> DataFrame:
    return fact.groupBy(*key).agg(F.count("*").alias("copies"))


def repeated_keys(fact: DataFrame, key: Sequence[str] = tuple(FACT_KEY)) -> DataFrame:
    """Keys held by more than one row."""
    return _copies(fact, key).where("copies > 1")


def _duplicate_row(column: str) -> Check:
    return (
        "no duplicate fact keys",
        CRITICAL,
        F.col(column) == 0,
        _say(F.col(column), " keys are held by more than one row"),
    )


def duplicate_check(fact: DataFrame) -> DataFrame:
    summary = repeated_keys(fact).agg(F.count("*").alias("n"))
    return _as_rows(summary, [_duplicate_row("n")])


def _orphan_row() -> Check:
    return (
        "no orphan org_codes in fact",
        CRITICAL,
        F.col("orphans") == 0,
        _say(F.col("orphans"), " codes of the fact lack an organisation"),
    )


def orphan_check(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    return _as_rows(orphan_count(fact, trusts), [_orphan_row()])


def plausibility_checks(base: DataFrame, expect: Expectations) -> DataFrame:
    """Totals, counts, means and balances from one pass over ``gold.measure_base``."""
    this_year = F.col("financial_year") == expect.year
    kpi_year = this_year & F.col("has_kpi")
    surplus = F.col("operating_surplus_000s")
    gap = F.abs(F.col("total_income_000s") - F.col("total_expenditure_000s") - surplus)
    wte = F.col("total_wte")
    pay = num.percent("kpi_pay_000s", "kpi_income_000s")
    in_sector = kpi_year & (F.col("sector") == expect.pay_sector)
    summary = base.agg(
        num.sum_if(this_year, "total_income_000s").alias("income"),
        num.count_if(kpi_year & (surplus < 0)).alias("deficits"),
        num.rounded_mean(F.when(kpi_year, F.col("ebitda_margin_pct"))).alias("ebitda"),
        num.rounded_mean(F.when(in_sector, pay)).alias("pay"),
        num.count_if(gap > expect.balance_tolerance_000s).alias("unbalanced"),
        num.count_if((wte <= 0) | (wte > expect.wte_max)).alias("odd_wte"),
    ).select(
        F.coalesce(F.round(num.in_units("income", num.BILLIONS), 1), F.lit(0.0)).alias("income_bn"),
        F.coalesce(num.in_units("income", num.BILLIONS), F.lit(0.0)).alias("income_exact"),
        "deficits",
        F.coalesce("ebitda", F.lit(0.0)).alias("ebitda"),
        F.coalesce("pay", F.lit(0.0)).alias("pay"),
        "unbalanced",
        "odd_wte",
    )

    def between(column: str, limits: tuple) -> Column:
        return F.col(column).between(*limits)

    year = expect.year
    return _as_rows(
        summary,
        [
            (
                f"total income {year} in expected range",
                WARNING,
                between("income_exact", expect.income_bn),
                _say("£", text.plain_decimal(F.col("income_bn")), "bn (expected £{}–{}bn)".format(*expect.income_bn)),
            ),
            (
                f"deficit trust count {year}",
                WARNING,
                between("deficits", expect.deficits),
                _say(F.col("deficits"), " organisations below zero (limits {}–{})".format(*expect.deficits)),
            ),
            (
                f"avg EBITDA margin {year}",
                WARNING,
                between("ebitda", expect.ebitda_pct),
                _say(text.plain_decimal(F.col("ebitda")), "% (expected {}–{}%)".format(*expect.ebitda_pct)),
            ),
            (
                f"avg pay % {expect.pay_sector.lower()} trusts {year}",
                WARNING,
                between("pay", expect.pay_pct),
                _say(text.plain_decimal(F.col("pay")), "% (benchmark {}–{}%)".format(*expect.pay_pct)),
            ),
            (
                "income - expenditure = operating surplus",
                WARNING,
                F.col("unbalanced") == 0,
                _say(F.col("unbalanced"), " organisation-years whose surplus is not income less spending"),
            ),
            (
                f"WTE values plausible (0 < WTE ≤ {expect.wte_max:,})",
                WARNING,
                F.col("odd_wte") == 0,
                _say(F.col("odd_wte"), " organisation-years with a staff count outside the limits"),
            ),
        ],
    )


def all_checks(
    fact: DataFrame, trusts: DataFrame, base: DataFrame, expect: Expectations
) -> dict[str, Callable[[], DataFrame]]:
    return checks_of_state(fact_state(fact), trusts, base, expect)


def checks_of_state(
    state: DataFrame, trusts: DataFrame, base: DataFrame, expect: Expectations
) -> dict[str, Callable[[], DataFrame]]:
    """All checks from ``fact_state`` and ``gold.measure_base``: one pass over each."""
    return {
        "fact": lambda: state_checks(state, trusts, expect),
        "trust count": lambda: trust_count_check(trusts, expect),
        "plausibility": lambda: plausibility_checks(base, expect),
    }


def check_frame(checks: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """All checks as one lazy frame."""
    return reduce(DataFrame.unionByName, (build() for build in checks.values()))


@dataclass
class Report:
    rows: list[tuple]

    @property
    def critical_failures(self) -> int:
        return sum(1 for r in self.rows if r[1] == CRITICAL and not r[2])

    @property
    def failures(self) -> int:
        return sum(1 for r in self.rows if not r[2])

    @property
    def exit_code(self) -> int:
        return 1 if self.critical_failures else 0

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, REPORT_SCHEMA)


def run_checks(checks: Mapping[str, Callable[[], DataFrame]]) -> Report:
    """Run every group; a group that fails becomes one CRITICAL row. Results are a few rows each."""
    rows: list[tuple] = []
    for name, build in checks.items():
        stamp = dt.datetime.now(dt.timezone.utc).isoformat()
        try:
            found = [tuple(r) for r in build().collect()]
        except Exception as error:  # noqa: BLE001 - any failure is a finding
            found = [(name, CRITICAL, False, f"Exception: {str(error).splitlines()[0]}")]
        rows.extend((*r, stamp) for r in found)
    return Report(rows)
