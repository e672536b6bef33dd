"""Queries with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql_scan(spark: SparkSession, query: str, **parameters: object) -> DataFrame:
    """Run a query with bound parameters (``:name`` in the text)."""
    return spark.sql(query, args=parameters or None)

