"""Scratch tables: results that several later steps read, cut from their lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.session import drop_scratch, scratch_path


def stored(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` below ``spark.checkpoint.dir`` and read it back.

    Every executor sees the files, so a lost one costs only its running tasks.
    """
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table.scratch = path
    return table


def discard(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Delete tables made by ``stored`` that no frame reads any more."""
    for table in tables:
        if table is not None:
            drop_scratch(spark, table.scratch)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def same(left: str, right: str):
    """Null-safe equality of two named columns, as a join condition."""
    return F.col(left).eqNullSafe(F.col(right))
