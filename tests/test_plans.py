"""What the physical plans look like: pruning, pushdown, shuffles, no Python, no cross joins."""

from __future__ import annotations

import re

import pytest

from ledgerwide import reference_data as ref
from ledgerwide.operators import measures, quality
from ledgerwide.plans import gold, load, trends
from ledgerwide.schemas import FACT_SCHEMA
from ledgerwide.sources import derived, staging
from tests.conftest import FOLDER
from verification.queries import QUERIES, Inputs

WRITES_OR_RUNS = {
    "S6_load_staging", "S7_export_query", "S8_csv_exports", "S9_validation_report",
    "M4_load_files_twice", "M5_stream_load", "S4b_mixed_headers", "S6b_emptied_scope", "S11b_stored_codes", "S11c_stored_years",
    "M6_stream_late_providers", "M7_load_mixed_headers", "M8_refused_load", "M9_quarantine", "M10_changed_rows", "S8b_export_contents", "V9_stored_views",
    "D14b_stored_checks",
}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    fact = load.clustered(derived.fact(spark, FOLDER))
    staging.overwrite_scopes(fact, path, by=["financial_year"])
    return staging.read_table(spark, path, FACT_SCHEMA)


@pytest.fixture(scope="module")
def trusts(spark):
    return derived.trusts(spark, FOLDER)


def fact_scans(plan: str) -> list[str]:
    return [line for line in plan.split("\n") if "FileScan" in line and "sub_code" in line]


def test_scorecard_scans_the_fact_once(spark, stored, trusts):
    plan = plan_of(gold.scorecard(stored, trusts, ref.code_dimension(spark)))
    (scan,) = fact_scans(plan)
    assert "PushedFilters: [" in scan and "worksheet_name" in scan.split("PushedFilters")[1]
    schema = scan.split("ReadSchema: ")[1]
    assert "total_000s" in schema and "source_file" not in schema and "table_id" not in schema
    # One shuffle of the reduced rows by organisation and year; none of the raw rows.
    assert len(re.findall(r"Exchange hashpartitioning\(org_code#\d+, financial_year#\d+", plan)) == 1


def test_one_schedule_view_pushes_its_filter(stored, trusts):
    (scan,) = fact_scans(plan_of(gold.balance_sheet(stored, trusts)))
    assert "EqualTo(worksheet_name,TAC03 SoFP)" in scan


def test_year_filter_prunes_partitions(spark, stored, trusts):
    card = gold.scorecard(stored, trusts, ref.code_dimension(spark))
    (scan,) = fact_scans(plan_of(trends.sector_comparison(card, "2000/01")))
    assert "2000/01" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_wide_aggregates_stay_compilable(spark, stored, trusts):
    """The JVM does not compile methods above 8,000 bytes; wide pivots must stay below."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        codes = ref.code_dimension(spark)
        frames = [*gold.views(stored, trusts, codes).values(), gold.measure_base(stored, trusts, codes)]
        for frame in frames:
            text = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unused_measures_are_not_computed(spark, stored, trusts):
    base = gold.measure_base(stored, trusts, ref.code_dimension(spark))
    plan = plan_of(measures.measure(base, "total_wte"))
    assert "STA0410" in plan and "STA0310" not in plan and "EXP0130" not in plan


def test_global_benchmark_is_no_cross_join(spark, stored, trusts):
    base = gold.measure_base(stored, trusts, ref.code_dimension(spark))
    frame = measures.measure(base, ["sector_benchmark_ebitda_pct", "ebitda_vs_benchmark_pp"], ["region"])
    assert "NestedLoop" not in plan_of(frame) and "Cartesian" not in plan_of(frame)
    assert len({r["sector_benchmark_ebitda_pct"] for r in frame.collect()}) == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_OR_RUNS))
def test_queries_stay_in_the_engine(spark, name):
    plan = plan_of(QUERIES[name](Inputs(spark, FOLDER)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


def test_views_are_stored_by_year(spark, stored, trusts, tmp_path):
    names = gold.write_views(stored, trusts, ref.code_dimension(spark), str(tmp_path))
    assert len(names) == 7
    back = spark.read.parquet(str(tmp_path / "kpis"))
    assert back.count() == gold.kpis(stored, trusts, ref.code_dimension(spark)).count()
    gold.register_views(stored, trusts, ref.code_dimension(spark))
    assert spark.sql("SELECT count(*) FROM scorecard").first()[0] == back.count()


def test_all_checks_scan_the_fact_twice(spark, stored, trusts):
    base = gold.measure_base(stored, trusts, ref.code_dimension(spark))
    frame = quality.check_frame(quality.all_checks(stored, trusts, base, quality.Expectations()))
    assert len(re.findall(r"FileScan parquet [^\n]*sub_code", plan_of(frame))) == 2
