"""Checks as stored state that follows the fact.

Two results are kept by year and bucket of organisations, as the views are: rows and repeated
keys of every organisation-year (``quality.fact_state``), and the base of the measures. After
a load ``refresh`` rewrites only their parts whose part of the fact, organisations or codes
changed. All checks are then sums over these two, one row for each organisation-year: a report
after a reload reads the touched parts of the fact and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwide import reference_data as ref
from ledgerwide.operators import quality
from ledgerwide.plans import gold, stored_views
from ledgerwide.plans.load import Tables
from ledgerwide.schemas import FACT_SCHEMA, TRUST_SCHEMA
from ledgerwide.sources import commits

PREFIX = "check"


def _state(fact: DataFrame) -> DataFrame:
    return quality.fact_state(fact)


def _base(change: commits.Change, fact: DataFrame) -> DataFrame:
    return gold.measure_base(fact, change.read("dim_trust", TRUST_SCHEMA), change.read("dim_subcode", ref.CODE_SCHEMA))


def _made(change: commits.Change, fact: DataFrame) -> dict[str, DataFrame]:
    return {"state": _state(fact), "base": _base(change, fact)}


def refresh(spark: SparkSession, tables: Tables) -> set[str]:
    """Bring the state up to the latest commit; returns the parts that were rewritten."""
    return stored_views.follow(spark, tables, PREFIX, _made)


def checks(
    spark: SparkSession, tables: Tables, expect: quality.Expectations
) -> dict[str, quality.Callable[[], DataFrame]]:
    """All checks as of the last refresh; the fact itself is not read."""
    change = commits.Change(spark, tables.root)
    none = change.read("fact", FACT_SCHEMA, ())
    state = change.read(f"{PREFIX}_state", _state(none).schema)
    base = change.read(f"{PREFIX}_base", _base(change, none).schema)
    return quality.checks_of_state(state, change.read("dim_trust", TRUST_SCHEMA), base, expect)
