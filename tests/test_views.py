"""Views on hand-made facts."""

from __future__ import annotations

import pytest

from ledgerwide import reference_data as ref
from ledgerwide.operators import enrich, measures, quality, yoy
from ledgerwide.plans import gold, peers, trends
from ledgerwide.schemas import FACT_SCHEMA

TRUSTS = "org_code string, organisation_name string, sector string, region string, trust_type string"


def fact_row(org, year, sheet, code, amount, main="A00CY01"):
    return (org, year, sheet, 1, main, code, amount, "NHS_TRUST", "f.csv")


@pytest.fixture(scope="module")
def trusts(rows):
    return rows(
        TRUSTS,
        ("AAA", "Alpha", "Acute", "North", "NHS_TRUST"),
        ("BBB", "Beta", None, "South", "FOUNDATION_TRUST"),
        ("CCC", "Gamma", "Acute", None, "NHS_TRUST"),
    )


@pytest.fixture(scope="module")
def fact(rows):
    return rows(
        FACT_SCHEMA,
        fact_row("AAA", "2023/24", ref.SOCI, "SCI0100A", 900),
        fact_row("AAA", "2023/24", ref.SOCI, "SCI0110A", 100),
        fact_row("AAA", "2023/24", ref.SOCI, "SCI0125A", -1020),
        fact_row("AAA", "2023/24", ref.SOCI, "SCI0140A", -20),
        fact_row("AAA", "2023/24", ref.SOCI, "SCI0240", -20),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP0130", 600),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP0170", 50),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP0170", 7, "A00CY02"),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP0240", 40),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP0390", 1020),
        fact_row("AAA", "2023/24", ref.EXPENDITURE, "EXP9990", 5),
        fact_row("AAA", "2023/24", ref.STAFF, "STA0410", 10),
        fact_row("AAA", "2023/24", ref.STAFF, "STA0410", 8, "A00CY01P"),
        fact_row("AAA", "2023/24", ref.INCOME_1, "INC0330", 3),
        # Income only, surplus missing: margin is missing too.
        fact_row("BBB", "2023/24", ref.SOCI, "SCI0110A", 500),
        # A summary row exists, but without income.
        fact_row("CCC", "2023/24", ref.SOCI, "SCI0140A", 10),
        # No organisation.
        fact_row("ZZZ", "2023/24", ref.SOCI, "SCI0100A", 1),
    )


@pytest.fixture(scope="module")
def codes(spark):
    return ref.code_dimension(spark)


def by_org(frame):
    return {r["org_code"]: r.asDict() for r in frame.collect()}


def test_income_expenditure(fact, trusts):
    got = by_org(gold.income_expenditure(fact, trusts))
    assert set(got) == {"AAA", "BBB", "CCC"}
    assert got["AAA"]["total_income_000s"] == 1000 and got["AAA"]["total_expenditure_000s"] == 1020
    assert got["BBB"]["patient_care_income_000s"] is None and got["BBB"]["total_income_000s"] == 500
    assert got["CCC"]["total_income_000s"] == 0 and got["CCC"]["total_expenditure_000s"] == 0
    strict = by_org(gold.income_expenditure(fact, trusts, coalesce_patient_income=False))
    assert strict["BBB"]["total_income_000s"] is None and strict["CCC"]["total_expenditure_000s"] is None


def test_breakdown_sums_categories_and_takes_the_largest_line(fact, trusts, codes):
    got = by_org(gold.expenditure_breakdown(fact, trusts, codes))["AAA"]
    assert got["pay_000s"] == 600
    assert got["non_pay_000s"] == 57  # both main codes; the unknown code is left out
    assert got["drugs_cost_000s"] == 50
    assert got["depreciation_amort_000s"] == 40


def test_single_pass_equals_separate_views(fact, trusts, codes):
    wide = by_org(gold.org_year_wide(fact, trusts, codes))
    staff = by_org(gold.workforce(fact, trusts))
    spend = by_org(gold.expenditure_breakdown(fact, trusts, codes))
    assert wide["AAA"]["total_wte"] == staff["AAA"]["total_wte"] == 10
    assert wide["AAA"]["pay_000s"] == spend["AAA"]["pay_000s"]
    assert wide["BBB"]["pay_000s"] is None  # no expenditure rows at all, so not 0
    assert wide["CCC"]["has_summary"] and not wide["CCC"]["has_staff"]


def test_kpis(fact, trusts, codes):
    got = by_org(gold.kpis(fact, trusts, codes))
    assert set(got) == {"AAA", "BBB"}
    alpha, beta = got["AAA"], got["BBB"]
    assert alpha["ebitda_000s"] == 20 and alpha["ebitda_margin_pct"] == 2.0
    assert (alpha["ebitda_rag"], alpha["surplus_rag"]) == ("Amber", "Amber")
    assert alpha["pay_pct_income"] == 60.0 and alpha["cost_per_wte_000s"] == 60.0
    assert alpha["is_deficit"] == 1 and beta["is_deficit"] == 0
    assert beta["ebitda_margin_pct"] is None and beta["ebitda_rag"] == "Red"


def test_scorecard_status_and_lines(fact, trusts, codes):
    got = by_org(gold.scorecard(fact, trusts, codes))
    assert got["AAA"]["private_patient_income_000s"] == 3
    assert got["AAA"]["surplus_rag"] == "Red"  # by sign here, by margin in the KPI view
    assert got["BBB"]["ebitda_rag"] == "Green"  # a missing margin is Green here


def test_enriched(fact, trusts, codes):
    got = by_org(enrich.enriched(gold.scorecard(fact, trusts, codes)))
    assert got["AAA"]["patient_income_pct"] == 90.0 and got["AAA"]["pay_pressure_flag"] == 0
    assert got["BBB"]["ebitda_rag"] is None and got["BBB"]["patient_income_pct"] is None


def test_previous_row_differs_from_previous_year(rows):
    frame = rows(
        "org_code string, financial_year string, v double",
        ("AAA", "2019/20", 1.0), ("AAA", "2021/22", 3.0), ("AAA", "2022/23", 4.0),
    )
    got = {
        r[0]: (r[1], r[2])
        for r in frame.select(
            "financial_year", yoy.prior_row("v"), yoy.prior_year("v", ["org_code"])
        ).collect()
    }
    assert got["2021/22"] == (1.0, None) and got["2022/23"] == (3.0, 3.0)


def test_margin_on_a_band_edge_counts_twice(rows):
    card = rows(
        "org_code string, financial_year string, sector string, ebitda_margin_pct double",
        *((f"O{i}", "2023/24", "Acute", m) for i, m in enumerate([-1.0, 0.0, 2.0, 5.0, 5.1])),
    )
    got = trends.ebitda_distribution(card).first()
    assert (got["negative_ebitda"], got["low_0_2"], got["mid_2_5"], got["high_gt5"]) == (1, 2, 2, 1)


def test_movers_need_both_years(rows):
    card = rows(
        "org_code string, organisation_name string, sector string, region string, financial_year string, "
        "total_income_000s bigint, ebitda_margin_pct double, is_deficit int",
        ("AAA", "Alpha", "Acute", "N", "2022/23", 1000, 3.0, 0),
        ("AAA", "Alpha", "Acute", "N", "2023/24", 1000, 1.0, 1),
        ("BBB", "Beta", "Acute", "N", "2023/24", 1000, 9.0, 0),
    )
    got = [tuple(r) for r in peers.ebitda_movers(card).collect()]
    assert got == [("Alpha", "Acute", "N", "1", "3.0%", "1.0%", "-2.0pp", "DEFICIT")]


def test_measures_under_a_filter(fact, trusts, codes):
    base = gold.measure_base(fact, trusts, codes)
    got = measures.measure(
        base, ["total_income_m", "deficit_trusts", "prior_year", "ebitda_rag", "selected_sector"],
        filters={"sector": "Acute", "financial_year": "2023/24"},
    ).collect()
    assert [tuple(r) for r in got] == [("2023/24", 1.0, 1, "2022/23", "Amber", "Acute")]
    everything = measures.measures(base, ["financial_year"]).first()
    assert everything["deficit_count_label"] == "1 of 2 trusts in deficit"
    assert everything["deficit_trusts_yoy_change"] == 1
    assert everything["prior_year_income_m"] is None and everything["income_yoy_growth_pct"] is None
    assert len(set(measures.measures(base).columns)) == 52  # 51 measures and the key


def test_checks_report_and_isolate_failures(spark, fact, trusts, codes):
    expect = quality.Expectations(fact_rows_min=5, trusts_min=3, years=["2023/24", "2021/22"])
    base = gold.measure_base(fact, trusts, codes)
    groups = quality.all_checks(fact, trusts, base, expect)

    def broken():
        raise RuntimeError("table is gone")

    report = quality.run_checks({**groups, "extra": broken})
    found = {r[0]: (r[1], r[2], r[3]) for r in report.rows}
    assert found["fact row count"] == ("CRITICAL", True, "17 rows (expected ≥ 5)")
    assert found["year coverage: 2021/22"] == ("CRITICAL", False, "MISSING in fact")
    assert found["no orphan org_codes in fact"][1] is False
    assert found["no duplicate fact keys"][1] is True
    assert found["extra"] == ("CRITICAL", False, "Exception: table is gone")
    assert report.critical_failures == 3 and report.exit_code == 1
    assert report.frame(spark).count() == len(report.rows)
