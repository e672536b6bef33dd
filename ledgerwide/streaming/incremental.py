"""File-by-file load as a stream.

The landing folders are file streams; every micro-batch goes through the same change of the
warehouse as a batch load. The checkpoint remembers which files were taken, and a change
replaces scopes and upserts by key, so a batch that runs twice after a failure leaves the
same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwide.plans.load import Tables, load, scopes_of, take_batch
from ledgerwide.sources import landing

RAW_SCHEMA = (
    "OrganisationName string, WorkSheetName string, TableID int, MainCode string, "
    "RowNumber int, SubCode string, Total double"
)
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def _arrivals(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """New files of a folder and what they are. Their contents are not read."""
    files = spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.lit(kind).alias("kind"))


def load_new_files(
    spark: SparkSession,
    folder: str,
    tables: Tables,
    providers: DataFrame | str,
    checkpoint: str,
    schema: str = RAW_SCHEMA,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Load every landing file not loaded yet, then stop (``availableNow``).

    ``providers`` is the folder of provider landings, which is watched like the other, or a
    frame that holds for every batch. Statements whose provider list has not come yet wait in
    the quarantine; the batch that brings the list brings them into the fact.

    The stream only tells which files are new; they are read by their own headers, as a batch
    load reads them, so a file with other columns is mapped by name or refused, and ``schema``
    is not used any more. All new files form one batch: staging replaces (year, type) scopes,
    so the parts of a large file must not be split over batches.
    """
    arrivals = _arrivals(spark, folder, "rows")
    if isinstance(providers, str):
        arrivals = arrivals.unionByName(_arrivals(spark, providers, "providers"))

    def take(batch: DataFrame, batch_id: int) -> None:
        part = F.element_at(F.split("path", "/"), -1).startswith("part-")
        landed = F.when(part, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
        # One path per landing, as few as a batch load is given.
        found = batch.select("kind", F.url_decode(landed)).distinct().collect()
        rows, lists = (sorted(path for k, path in found if k == kind) for kind in ("rows", "providers"))
        if isinstance(providers, str):
            if rows or lists:
                load(spark, tables, rows, lists, file_format)
        elif rows:
            staged = landing.read_statement_rows(spark, rows, file_format)
            take_batch(spark, tables, staged, providers, scopes_of(spark, rows))

    return (
        arrivals.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
