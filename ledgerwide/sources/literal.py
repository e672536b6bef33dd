"""Small literal tables whose size Spark knows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows stated in code, as a local relation.

    Its byte size is in the plan, so joins broadcast it by themselves when it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it when it is not.
    """
    names = [field.split()[0] for field in schema.split(",")]
    columns = zip(*rows) if rows else [[] for _ in names]
    table = pa.table({name: list(values) for name, values in zip(names, columns)})
    return spark.createDataFrame(table, schema)
