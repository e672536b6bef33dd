"""Row numbers, tiles and top-k without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwide.session import scratch_root


def numbered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    number: str = "row_number",
    size: str = "group_rows",
) -> DataFrame:
    """Exact row number and group size for groups of any size.

    A window over the group would sort all of it in one task. Here the rows are
    range-partitioned on group and order, so one group spreads over many
    partitions; each row's number is its position in its partition plus the rows
    of the group in earlier partitions. ``order`` must be total (end it with a
    unique column), which also lets equal values split across partitions.

    The range-partitioned rows are checkpointed: range bounds come from sampling,
    and both uses of the partition ids must see the same bounds. The offsets are an
    aggregate of those rows, and adaptive execution picks their join from measured bytes.
    The checkpoint's files go with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    spark = df.sparkSession
    scratch_root(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in groups]
    spread = (
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .checkpoint()
    )
    # At most one row per partition and group boundary.
    before = Window.partitionBy(*groups).orderBy("_part")
    offsets = (
        spread.groupBy(*groups, "_part")
        .agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
        .select(
            *(F.col(g).alias(f"_g_{g}") for g in groups),
            F.col("_part").alias("_p"),
            "_first",
            F.coalesce(
                F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_earlier"),
            F.sum("_rows").over(Window.partitionBy(*groups)).alias(size),
        )
    )
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    placed = spread.join(offsets, same, "inner")
    return placed.select(
        *df.columns, (F.col("_at") - F.col("_first") + 1 + F.col("_earlier")).alias(number), size
    )


def tile_of(number: Column, size: Column, tiles: int) -> Column:
    """Tile for a row number: the first ``size % tiles`` tiles hold one row more."""
    small = F.floor(size / tiles)
    large_tiles = size % tiles
    in_large = large_tiles * (small + 1)
    return (
        F.when(number <= in_large, F.ceil(number / (small + 1)))
        .otherwise(large_tiles + F.ceil((number - in_large) / F.nullif(small, F.lit(0))))
        .cast("int")
    )


def tiles(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], count: int, name: str
) -> DataFrame:
    """NTILE over each group."""
    placed = numbered(df, groups, order, "_n", "_size")
    return placed.select(*df.columns, tile_of(F.col("_n"), F.col("_size"), count).alias(name))


def top(df: DataFrame, order: Sequence[Column], tie_break: str, limit: int) -> DataFrame:
    """The first ``limit`` rows. Each task keeps ``limit`` rows, so no full sort takes place."""
    return df.orderBy(*order, F.col(tie_break)).limit(limit)


def top_ranked(
    df: DataFrame, order: Sequence[Column], tie_break: str, limit: int, name: str
) -> DataFrame:
    """Top rows with their RANK among all rows.

    The rank of a kept row only depends on rows before it, which are kept too, so
    ranking the kept rows equals ranking everything.
    """
    kept = top(df, order, tie_break, limit)
    return kept.withColumn(name, F.rank().over(Window.orderBy(*order)))
