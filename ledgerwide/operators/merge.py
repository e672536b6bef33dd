"""Keyed upserts.

Sequential insert-or-update means: for every key some columns keep their first
value and others take the last. Within a batch both are ``min_by`` and ``max_by`` over
the load order; the reduced batch then joins the rows that are there already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.schemas import FACT_KEY

FACT_KEPT = ["worksheet_name", "table_id", "trust_type"]
FACT_UPDATED = ["total_000s", "source_file"]


TIES = ["organisation_name", "worksheet_name", "table_id", "total_000s"]


def _settled(batch: DataFrame, key: Sequence[str], kept: Sequence[str], updated: Sequence[str]) -> DataFrame:
    """One row per key of a batch: kept columns of its first row, updated ones of its last.

    The order is total: file, row number, then the columns that tell tied rows apart. Rows are
    compared whole, so that no text is carried to the reducers both as order and as value.
    """
    order = ["source_file", "row_num", *(c for c in TIES if c in batch.columns)]
    fields = {c: F.col(c) for c in order} | {"row_num": F.col("row_num").cast("int").alias("row_num")}
    first = [*order, *(c for c in kept if c not in order)]
    last = [*order, *(c for c in updated if c not in order)]
    merged = batch.groupBy(*key).agg(
        F.min(F.struct(*[fields.get(c, F.col(c)) for c in first])).alias("_first"),
        F.max(F.struct(*[fields.get(c, F.col(c)) for c in last])).alias("_last"),
    )
    return merged.select(*key, *[f"_first.{c}" for c in kept], *[f"_last.{c}" for c in updated])


def upsert_fact(
    existing: DataFrame | None,
    batch: DataFrame,
    key: Sequence[str] = tuple(FACT_KEY),
    kept: Sequence[str] = tuple(FACT_KEPT),
    updated: Sequence[str] = tuple(FACT_UPDATED),
) -> DataFrame:
    """New rows replace amount and source of an existing key and keep the rest.

    Only the batch is reduced by key; the old rows meet it in joins, so a small batch is
    broadcast by measured size and the old fact is neither sorted nor shuffled. Within a
    batch the row of the later file wins, then the higher ``row_num``.
    """
    columns = [*key, *kept, *updated]
    new = _settled(batch, key, kept, updated).select(*columns)
    if existing is None:
        return new
    marked = new.select(*key, *[F.col(c).alias(f"_new_{c}") for c in updated], F.lit(True).alias("_hit"))
    old = existing.join(marked, list(key), "left").select(
        *key,
        *kept,
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in updated],
    )
    return old.unionByName(new.join(existing.select(*key), list(key), "left_anti"))


#: Rows of a task that reduces a batch by key, some 300 bytes each in its sort or hash table.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that hold at most ``TASK_ROWS`` each; an eighth where cores would stay idle."""
    return max(-(-rows // TASK_ROWS), min(-(-8 * rows // TASK_ROWS), spark.sparkContext.defaultParallelism), 1)


def settled_batch(batch: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per fact key of a batch, as ``upsert_fact`` takes it.

    With ``tasks`` the rows are dealt by key first: they move once and as they are, not as the
    first and the last row of each key, and their number bounds what a task sorts.
    """
    dealt = batch if tasks is None else batch.repartition(tasks, *FACT_KEY)
    return _settled(dealt, FACT_KEY, FACT_KEPT, FACT_UPDATED)


def fact_changes(existing: DataFrame, settled: DataFrame, stamps: Sequence[Column]) -> DataFrame:
    """Rows of a settled batch that are new or differ from the existing row of their key.

    They come whole: first values of the key's kept columns, the batch's amount and source,
    and ``stamps``. Existing rows are only probed, by a hash table of a task's share of them; the
    batch is the side that is reduced.
    """
    known = existing.select(
        *FACT_KEY, *[F.col(c).alias(f"_old_{c}") for c in (*FACT_KEPT, *FACT_UPDATED)], F.lit(True).alias("_known")
    )
    both = settled.join(known.hint("shuffle_hash"), FACT_KEY, "left")
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in FACT_UPDATED]
    equal = F.coalesce(F.col("_known") & same[0] & same[1], F.lit(False))
    first = [F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in FACT_KEPT]
    return both.where(~equal).select(*FACT_KEY, *first, *FACT_UPDATED, *stamps)


def with_changes(existing: DataFrame, changes: DataFrame) -> DataFrame:
    """Existing rows with those of ``changes`` in place of the ones that have their keys.

    A task holds its share of the changed keys in a hash table; existing rows stream by unsorted.
    """
    kept = existing.join(changes.select(*FACT_KEY).hint("shuffle_hash"), FACT_KEY, "left_anti")
    return kept.unionByName(changes.select(*existing.columns))


def stamped_trusts(merged: DataFrame, existing: DataFrame | None, stamps: Sequence[Column]) -> DataFrame:
    """``merged`` with the stamps of ``existing`` where nothing changed and new ones elsewhere."""
    fields = [c for c in merged.columns if c != "org_code"]
    if existing is None:
        return merged.select("*", *stamps)
    names = [c for c in existing.columns if c not in merged.columns]
    old = existing.select("org_code", F.struct(*fields).alias("_before"), *[F.col(c).alias(f"_old_{c}") for c in names])
    both = merged.join(old, "org_code", "left").withColumn("_same", F.col("_before").eqNullSafe(F.struct(*fields)))
    stamped = {c: s for c, s in zip(names, stamps)}
    return both.select(
        *merged.columns, *[F.when(F.col("_same"), F.col(f"_old_{c}")).otherwise(stamped[c]).alias(c) for c in names]
    )


def trusts_from_providers(providers: DataFrame) -> DataFrame:
    """One row per code: first name and type, latest known sector and region, years seen."""
    order = F.struct("financial_year", "source_file", "organisation_name", "sector", "region")

    def latest_known(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)

    return (
        providers.where(F.length(F.trim("org_code")) == 3)
        .groupBy("org_code")
        .agg(
            F.min_by(F.struct("organisation_name", "trust_type"), order).alias("_first"),
            latest_known("sector"),
            latest_known("region"),
            F.min("financial_year").alias("first_year_seen"),
            F.max("financial_year").alias("last_year_seen"),
        )
        .select(
            "org_code",
            "_first.organisation_name",
            "_first.trust_type",
            "sector",
            "region",
            (F.col("_first.trust_type") == "FOUNDATION_TRUST").cast("int").alias("is_foundation"),
            "first_year_seen",
            "last_year_seen",
        )
    )


def upsert_trusts(existing: DataFrame | None, providers: DataFrame) -> DataFrame:
    """Overwrite-in-place dimension upsert.

    Known codes keep name, type and first year; sector and region change only to a
    known value; the last year moves forward to the newest year of the code's own rows.
    """
    new = trusts_from_providers(providers)
    if existing is None:
        return new
    old, fresh = existing.alias("o"), new.alias("n")
    both = old.join(fresh, F.col("o.org_code") == F.col("n.org_code"), "full_outer")

    def settled(column: str, *sides: str) -> Column:
        return F.coalesce(*(F.col(f"{side}.{column}") for side in sides)).alias(column)

    return both.select(
        settled("org_code", "o", "n"),
        settled("organisation_name", "o", "n"),
        settled("trust_type", "o", "n"),
        settled("sector", "n", "o"),
        settled("region", "n", "o"),
        settled("is_foundation", "o", "n"),
        settled("first_year_seen", "o", "n"),
        F.greatest("o.last_year_seen", "n.last_year_seen").alias("last_year_seen"),
    )
