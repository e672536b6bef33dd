from __future__ import annotations

import csv
import glob

import pytest

from ledgerwide import reference_data as ref
from ledgerwide.operators import dictionary, plan_kpis
from ledgerwide.plans import exports
from ledgerwide.schemas import FACT_SCHEMA, TRUST_SCHEMA
from ledgerwide.sources.sinks import BYTE_ORDER_MARK, write_csv

GRID = "worksheet_name string, row_no int, cells array<string>"


def test_codes_from_a_template(spark, rows):
    grid = rows(
        GRID,
        ("TAC13 A&amp;B", 1, [None, " Cost  at\nstart ", "+", "INT0100"]),
        ("TAC13 A&amp;B", 2, [None, "TOTAL", "OLD1000", "INT0110A "]),
        ("TAC13 A&amp;B", 3, [None, "Later row of the same code", None, "INT0100"]),
        ("TAC13 A&amp;B", 4, ["Fallback wte", None, "+/-", "INT0120"]),
        ("TAC13 A&amp;B", 5, ["-", None, "INT0130", None]),
        ("TAC13 A&amp;B", 6, [None, "no code here", "INT01", None]),
        ("TAC09 Staff", 1, [None, "curated sheet", None, "STA9999"]),
        ("Intro", 1, [None, "cover", None, "ABC1234"]),
        ("TAC14X RoU Assets PY", 1, [None, "repeats", None, "ROU0100"]),
    )
    got = [
        (r["worksheet_name"], r["sub_code"], r["description"], r["expected_sign"], r["unit"], r["is_subtotal"])
        for r in dictionary.extract_codes(grid).orderBy("row_no").collect()
    ]
    assert got == [
        ("TAC13 A&B", "INT0100", "Cost at start", "+", "£000", 0),
        ("TAC13 A&B", "INT0110A", "TOTAL", None, "£000", 1),
        ("TAC13 A&B", "INT0120", "Fallback wte", "+/-", "No.", 0),
    ]
    curated = ref.code_dimension(spark)
    extended = dictionary.extend_codes(curated, dictionary.extract_codes(grid))
    assert extended.count() == curated.count() + 3


@pytest.mark.parametrize(
    ("label", "expected"), [("Total assets", 1), (" total x", 1), ("NET COST", 1), ("PFI", 0), ("Net cost", 0)]
)
def test_subtotal_labels(rows, label, expected):
    frame = rows("l string", (label,))
    assert frame.select(dictionary.is_subtotal_label("l")).first()[0] == expected


def test_csv_parts_carry_header_and_mark(rows, tmp_path):
    frame = rows("name string, v bigint", ('say "hi", £', 1), (None, 2), ("a", 3)).repartition(2)
    path = str(tmp_path / "out.csv")
    assert write_csv(frame, path) == 3
    seen = []
    for part in glob.glob(path + "/part-*.csv"):
        text = open(part, encoding="utf-8").read()
        assert text.startswith(BYTE_ORDER_MARK + "name,v")
        seen += list(csv.reader(text.splitlines()[1:]))
    assert sorted(seen) == [["", "2"], ["a", "3"], ['say "hi", £', "1"]]


def test_enriched_run_writes_its_own_folder(spark, rows, tmp_path):
    fact = rows(
        FACT_SCHEMA,
        ("AAA", "2023/24", ref.SOCI, 1, "A02CY01", "SCI0100A", 10, "NHS_TRUST", "f"),
        ("AAA", "2023/24", ref.EXPENDITURE, 1, "A08CY01", "EXP0130", 4, "NHS_TRUST", "f"),
    )
    trusts = rows(TRUST_SCHEMA, ("AAA", "Alpha", "NHS_TRUST", "ACUTE", "North", 0, "2023/24", "2023/24"))
    warehouse = exports.warehouse_of(spark, fact, trusts)
    counts = exports.write_enriched(warehouse, str(tmp_path / "enriched"))
    assert counts["kpis"] == 1 and counts["sector_benchmarks"] == 1 and counts["expenditure_detail"] == 1
    assert counts["dim_financial_year"] == 5
    back = spark.read.option("header", True).csv(str(tmp_path / "enriched" / "kpis.csv"))
    assert back.first()["sector"] == "Acute"


def test_capital_bands(rows):
    plan = [(c, a, 100) for c, a in (("a", 74), ("b", 75), ("c", 90), ("d", 110), ("e", 111))]
    frame = rows("k string, actual_000s bigint, plan_000s bigint", *plan, ("f", 1, 0))
    got = {r["k"]: r["rag"] for r in plan_kpis.capital_spend(frame, ["k"]).collect()}
    assert got == {"a": "Red", "b": "Amber", "c": "Green", "d": "Green", "e": "Red", "f": "Grey"}


def test_budget_variance_signs(rows):
    frame = rows(
        "k string, account_type string, period string, actual_000s bigint, budget_000s bigint",
        ("a", "INCOME", "M01", 99, 100), ("a", "INCOME", "M02", 105, 100), ("a", "PAY", "M01", 103, 100),
    )
    got = {
        (r["account_type"], r["period"]): (r["direction"], r["rag"], r["ytd_variance_000s"])
        for r in plan_kpis.budget_variance(frame, ["k", "account_type"]).collect()
    }
    assert got == {
        ("INCOME", "M01"): ("ADV", "Amber", -1),
        ("INCOME", "M02"): ("FAV", "Green", 4),
        ("PAY", "M01"): ("ADV", "Red", 3),
    }
