"""Partitioned tables that loads overwrite scope by scope."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from ledgerwide.schemas import SCOPE
from ledgerwide.sources import commits


def overwrite_scopes(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Replace exactly the partitions present in ``rows``; other partitions stay.

    One write replaces a delete followed by an append, and repeating it changes nothing.
    """
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(by or SCOPE))
        .parquet(path)
    )


def replace_scope(rows: DataFrame, path: str, financial_year: str, trust_type: str) -> None:
    """Replace one (year, type) scope, also when ``rows`` is empty and the scope must vanish."""
    scope = f"financial_year={quote(financial_year, safe='')}/trust_type={quote(trust_type, safe='')}"
    rows.drop(*SCOPE).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{scope}")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a partitioned table with its declared types and column order.

    A table that its root's commits name is read as the latest of them has it.
    """
    root, _, table = path.rstrip("/").rpartition("/")
    if commits.holds(spark, root, table):
        return commits.read(spark, root, table, schema)
    return spark.read.schema(schema).parquet(path).select(*commits.columns(schema))


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def swap_in(spark: SparkSession, beside: str, path: str) -> None:
    """Put a finished table in the place of another by renames.

    Between the renames the former table stands under ``former(path)``, where ``recover``
    finds it if the process ends there.
    """
    fs, new, target, old = _places(spark, beside, path, former(path))
    if fs.exists(target):
        fs.delete(old, True)
        fs.rename(target, old)
    if not fs.rename(new, target):
        raise OSError(f"cannot rename {beside} to {path}")
    fs.delete(old, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the former table if a swap ended between its renames."""
    fs, target, old = _places(spark, path, former(path))
    if not fs.exists(target) and fs.exists(old):
        fs.rename(old, target)


def former(path: str) -> str:
    return f"{path.rstrip('/')}__former"


def _places(spark: SparkSession, *paths: str) -> list:
    named = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [named[0].getFileSystem(spark._jsc.hadoopConfiguration()), *named]
