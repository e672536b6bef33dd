"""Names meet their codes without sorting the rows of a batch."""

from __future__ import annotations

from ledgerwide.operators import resolve
from ledgerwide.schemas import PROVIDER_SCHEMA, STAGED_SCHEMA


def test_rows_stream_by_the_list_unsorted(spark):
    staged = spark.createDataFrame(
        [("Abc", "w", 1, "A01CY01", 1, "S1", 5, "f", "NHS_TRUST", "2000/01", "CY"),
         ("gone", "w", 1, "A01CY01", 2, "S1", 6, "f", "NHS_TRUST", "2000/01", "CY")], STAGED_SCHEMA
    )
    listed = ("ABC", "RAA", None, None, None, "p", "NHS_TRUST", "2000/01")
    providers = spark.createDataFrame([listed, listed], PROVIDER_SCHEMA)
    for frame in (resolve.resolve_codes(staged, providers), resolve.unresolved_rows(staged, providers)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert frame.count() == 1
