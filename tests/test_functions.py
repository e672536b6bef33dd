from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwide.functions import fiscal, status, text
from ledgerwide.functions import numeric as num


def one(frame, *columns):
    """Evaluate columns on a single-row frame."""
    return tuple(frame.select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def test_year_and_type_from_file_name(rows):
    names = rows(
        "n string",
        ("TAC_NHS_trusts_2023-24.xlsx",),
        ("TAC_NHS_Foundation_trusts_1999-00.csv",),
    )
    got = [
        tuple(r)
        for r in names.select(text.financial_year_from_name("n"), text.trust_type_from_name("n")).collect()
    ]
    assert got == [("2023/24", "NHS_TRUST"), ("1999/00", "FOUNDATION_TRUST")]


def test_file_name_without_year_raises_or_is_null(rows):
    frame = rows("n string", ("no_year.csv",))
    assert frame.select(text.financial_year_from_name("n", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="no financial year"):
        frame.select(text.financial_year_from_name("n")).collect()


def test_fiscal_calendar(rows):
    dates = rows("d date", (dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),), (dt.date(2000, 1, 5),))
    got = [
        tuple(r)
        for r in dates.select(
            fiscal.label("d"), fiscal.period("d"), fiscal.quarter("d"), fiscal.prior_label(fiscal.label("d"))
        ).collect()
    ]
    assert got == [
        ("2023/24", "M12", "Q4", "2022/23"),
        ("2024/25", "M01", "Q1", "2023/24"),
        ("1999/00", "M10", "Q4", "1998/99"),
    ]
    assert fiscal.shift_label("2000/01", -1) == "1999/00"


def test_generated_years_match_the_published_ones(spark):
    years = [tuple(r) for r in fiscal.year_dimension(spark, 2019, 2023).orderBy("financial_year").collect()]
    assert years[0] == ("2019/20", dt.date(2019, 4, 1), dt.date(2020, 3, 31), "19/20", 1)
    assert years[-1] == ("2023/24", dt.date(2023, 4, 1), dt.date(2024, 3, 31), "23/24", 1)
    assert len(years) == 5


@pytest.mark.parametrize(
    ("margin", "ebitda", "surplus", "pay"),
    [
        (5.0, "Green", "Green", "Green"),
        (2.0, "Amber", "Green", "Green"),
        (1.9, "Red", "Green", "Green"),
        (0.0, "Red", "Green", "Green"),
        (-2.0, "Red", "Amber", "Green"),
        (-2.1, "Red", "Red", "Green"),
        (65.0, "Green", "Green", "Amber"),
        (70.0, "Green", "Green", "Red"),
        (None, "Grey", "Grey", "Grey"),
    ],
)
def test_status_edges(unit, margin, ebitda, surplus, pay):
    value = F.lit(margin).cast("double")
    got = one(
        unit,
        status.EBITDA_BANDS.status(value),
        status.SURPLUS_BANDS.status(value),
        status.PAY_BANDS.status(value),
    )
    assert got == (ebitda, surplus, pay)


def test_sign_status(unit):
    got = one(unit, *(status.sign_status(F.lit(v).cast("bigint")) for v in (-1, 0, 1, None)))
    assert got == ("Red", "Amber", "Green", "Green")


def test_sector_rules(rows):
    sectors = rows(
        "sector string, pay double",
        ("ACUTE", 66.0), ("Mental Health Trust", 66.0), ("Elsewhere", 66.0), (None, 66.0), ("Specialist", None),
    )
    canonical = status.canonical_sector("sector")
    got = [
        tuple(r)
        for r in sectors.select(
            canonical,
            status.pay_pressure_flag("pay", canonical),
            status.pay_pressure_flag("pay", canonical, status.PAY_AMBER_DEFAULT),
        ).collect()
    ]
    assert got == [
        ("Acute", 1, 1),
        ("Mental Health", 0, 0),
        ("Elsewhere", 0, 1),
        (None, 0, 1),
        ("Specialist", 0, 0),
    ]


def test_numbers(unit):
    assert one(unit, num.ratio(F.lit(1), F.lit(0)), num.percent(F.lit(1), F.lit(8)))[1] == 12.5
    assert one(unit, num.ratio(F.lit(1), F.lit(0))) == (None,)
    raw = [F.lit(v) for v in ("12.9", "-12.9", "x", None, "1.5E3", "NaN")]
    assert one(unit, *(num.truncate_to_integer(v.cast("string")) for v in raw)) == (12, -12, 0, 0, 1500, 0)
    a, b, none = F.lit(3.0), F.lit(1.0), F.lit(None).cast("double")
    assert one(
        unit, num.blank_minus(a, b), num.blank_minus(none, b), num.blank_minus(a, none), num.blank_minus(none, none)
    ) == (2.0, -1.0, 3.0, None)


def test_means_are_exact_and_skip_nulls(rows):
    frame = rows("v double", (0.1,), (0.2,), (None,), (0.3,))
    assert frame.agg(num.exact_mean("v")).first()[0] == pytest.approx(0.2, abs=0)
    assert frame.where("v > 9").agg(num.exact_mean("v")).first()[0] is None


def test_display_text(unit):
    got = one(
        unit,
        text.thousands(F.lit(1234.5), 0),
        text.thousands(F.lit(2.5), 0),
        text.thousands(F.lit(-1234.25), 1),
        text.percent_text(F.lit(4.0)),
        text.percent_text(F.lit(None).cast("double")),
        text.signed_points_text(F.lit(1.2)),
        text.signed_points_text(F.lit(-1.2)),
        text.signed_points_text(F.lit(0.0)),
    )
    assert got == ("1,235", "3", "-1,234.3", "4.0%", None, "+1.2pp", "-1.2pp", "0.0pp")
