"""CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "﻿"


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = True) -> int:
    """Write headered UTF-8 CSV and return the number of rows.

    ``path`` becomes a folder of part files, in the frame's order: a single file
    would pull the whole dataset through one task. Every part starts with the
    header, and with the byte order mark that spreadsheet tools look for. Rows are
    counted while they are written, not by a second job.
    """
    seen = Observation()
    first, *rest = df.columns
    mark = BYTE_ORDER_MARK if byte_order_mark else ""
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")).toDF(mark + first, *rest)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return int(seen.get["rows"])
