"""Code dictionary from template sheets.

A template sheet is a grid: ``worksheet_name string, row_no int, cells array<string>``,
one row per sheet row. Rules work on the cell array with higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions.text import col

# Shape of a code cell, sign cells, and the sheet that holds no codes.
CODE_PATTERN = r"^[A-Z]{2,4}\d{3,5}[A-Z]?$"
SIGN_TOKENS = ["+", "-", "+/-"]
COVER_SHEET = "Intro"

LABEL_CELL = 2  # labels stand in the second column


def strip(value: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def clean_label(label: str | Column) -> Column:
    """White-space runs become one blank."""
    return strip(F.regexp_replace(col(label), r"\s+", " "))


def clean_worksheet_name(name: str | Column) -> Column:
    return F.replace(col(name), F.lit("&amp;"), F.lit("&"))


def is_subtotal_label(label: str | Column) -> Column:
    """1 for labels that start with "total" or have over three letters, all capitals."""
    letters = F.regexp_replace(col(label), "[^A-Za-z]", "")
    capitals = (F.length(letters) > 3) & (letters == F.upper(letters))
    return (F.lower(strip(col(label))).startswith("total") | capitals).cast("int")


def infer_unit(label: str | Column) -> Column:
    return F.when(F.upper(col(label)).contains("WTE"), "No.").otherwise("£000")


def skipped_worksheets() -> list[str]:
    return [COVER_SHEET, *ref.CURATED_WORKSHEETS, *ref.COLLIDING_WORKSHEETS]


def keep_worksheet(name: str | Column) -> Column:
    return ~col(name).isin(skipped_worksheets())


def _is_code(cell: Column) -> Column:
    return strip(cell).rlike(CODE_PATTERN)


def _is_sign(cell: Column) -> Column:
    return strip(cell).isin(SIGN_TOKENS)


def _first(cells: Column, test) -> Column:
    return F.try_element_at(F.filter(cells, test), F.lit(1))


def extract_codes(grid: DataFrame, skip: bool = True) -> DataFrame:
    """Codes of each sheet with label and sign, in dictionary columns plus ``row_no``.

    A row's code is its last code-shaped cell and its label the second cell, or
    else the first cell that is neither sign nor code. Rows without a label do not
    count; the first row of a code in a sheet wins, found by ``min_by`` so that a
    code repeated many times is reduced on the map side.
    """
    cells = F.col("cells")
    second = F.try_element_at(cells, F.lit(LABEL_CELL))
    fallback = strip(_first(cells, lambda c: c.isNotNull() & ~_is_sign(c) & ~_is_code(c)))
    rows = grid.select(
        clean_worksheet_name("worksheet_name").alias("worksheet_name"),
        "row_no",
        strip(F.try_element_at(F.filter(cells, _is_code), F.lit(-1))).alias("sub_code"),
        F.when(F.length(strip(second)) > 0, second).otherwise(fallback).alias("label"),
        strip(_first(cells, _is_sign)).alias("expected_sign"),
    ).where("sub_code IS NOT NULL AND label IS NOT NULL")
    if skip:
        rows = rows.where(keep_worksheet("worksheet_name"))
    firsts = rows.groupBy("worksheet_name", "sub_code").agg(
        F.min_by(F.struct("label", "expected_sign", "row_no"), F.col("row_no")).alias("f")
    )
    label = clean_label("f.label")
    return firsts.select(
        "sub_code",
        "worksheet_name",
        label.alias("description"),
        F.col("f.expected_sign").alias("expected_sign"),
        infer_unit(label).alias("unit"),
        is_subtotal_label(label).alias("is_subtotal"),
        F.lit(None).cast("string").alias("analytics_category"),
        F.col("f.row_no").alias("row_no"),
    )


def extend_codes(curated: DataFrame, extracted: DataFrame) -> DataFrame:
    """Curated codes plus extracted ones that are new; one row per code."""
    fields = [f for f in curated.columns if f != "sub_code"]
    new = (
        extracted.join(curated.select("sub_code"), "sub_code", "left_anti")
        .groupBy("sub_code")
        .agg(F.min_by(F.struct(*fields), F.struct("worksheet_name", "row_no")).alias("f"))
        .select("sub_code", "f.*")
    )
    return curated.unionByName(new)
