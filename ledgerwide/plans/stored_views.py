"""The seven views as stored tables that follow the fact.

Views are stored like the fact, by year and bucket of organisations. An organisation-year lies
in one part of the fact, so a part of a view depends on the same part of the fact, on the
attributes of its organisations, and on the code dimension. ``refresh`` compares the versions
that the last commit names with those the views were made from, and rewrites only the parts
whose inputs changed, all views in one commit.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.plans import gold
from ledgerwide.plans.load import FACT_PARTS, Tables, bucket_of
from ledgerwide.schemas import FACT_SCHEMA, ORG_ATTRIBUTES, TRUST_SCHEMA
from ledgerwide.session import bounded_tasks, drop_scratch, scratch_path
from ledgerwide.sources import commits

#: What stored results name in the log: the versions that they were made from, each under the
#: results' prefix, and the attributes of organisations that they show.
MADE_FROM = {"fact": "fact", "codes": "dim_subcode", "dim_trust": "dim_trust"}
ATTRIBUTES = "trusts"

WRITERS = 4  # results written at the same time


def _views(change: commits.Change, fact: DataFrame) -> dict[str, DataFrame]:
    trusts = change.read("dim_trust", TRUST_SCHEMA)
    return gold.views(fact, trusts, change.read("dim_subcode", ref.CODE_SCHEMA))


def _buckets_of_changed(change: commits.Change, buckets: int, prefix: str) -> set[int]:
    """Buckets that hold an organisation whose attributes differ from those the results show."""
    names = ["org_code", *ORG_ATTRIBUTES]
    now = change.read("dim_trust", TRUST_SCHEMA).select("org_code", F.struct(*ORG_ATTRIBUTES).alias("now"))
    shown = change.read(f"{prefix}_{ATTRIBUTES}", ", ".join(f"{n} string" for n in names))
    shown = shown.select("org_code", F.struct(*ORG_ATTRIBUTES).alias("shown"))
    changed = now.join(shown, "org_code", "full_outer").where(~F.col("now").eqNullSafe(F.col("shown")))
    # At most one value for each bucket.
    return {r[0] for r in changed.select(bucket_of(buckets)).distinct().collect()}


def stale_parts(change: commits.Change, prefix: str = "view") -> set[str]:
    """Parts of the stored results whose inputs have changed since their last refresh."""
    fact, shown = change.partitions("fact"), change.partitions(f"{prefix}_fact")
    if change.partitions("dim_subcode") != change.partitions(f"{prefix}_codes"):
        return {*fact, *shown}
    stale = {p for p in {*fact, *shown} if fact.get(p) != shown.get(p)}
    if change.partitions("dim_trust") != change.partitions(f"{prefix}_dim_trust"):
        hit = {f"org_bucket={b}" for b in _buckets_of_changed(change, change.base.notes["buckets"], prefix)}
        stale |= {p for p in {*fact, *shown} if p.split("/")[1] in hit}
    return stale


def refresh(spark: SparkSession, tables: Tables) -> set[str]:
    """Bring the stored views up to the latest commit; returns the parts that were rewritten.

    Five views are projections of one wide frame, which is pivoted once and stored meanwhile.
    """
    shared = scratch_path(spark, "wide")

    def made(change: commits.Change, fact: DataFrame) -> dict[str, DataFrame]:
        trusts = change.read("dim_trust", TRUST_SCHEMA)
        wide = gold.org_year_wide(fact, trusts, change.read("dim_subcode", ref.CODE_SCHEMA))
        wide.write.parquet(shared)
        return gold.views_of(spark.read.schema(wide.schema).parquet(shared), fact, trusts)

    try:
        return follow(spark, tables, "view", made)
    finally:
        drop_scratch(spark, shared)


def follow(
    spark: SparkSession, tables: Tables, prefix: str, made: Callable[[commits.Change, DataFrame], dict[str, DataFrame]]
) -> set[str]:
    """Rewrite the stale parts of stored results, in one commit; returns those parts.

    ``made`` gives the results by name from a change and the stale parts of the fact; they are
    stored as ``<prefix>_<name>`` by year and bucket, so rows need org_code and financial_year.
    """
    change = commits.Change(spark, tables.root)
    if not change.partitions("fact"):
        return set()
    buckets = change.base.notes["buckets"]
    try:
        stale = stale_parts(change, prefix)
        if stale:
            fact = change.read("fact", FACT_SCHEMA, stale)

            def store(name: str, frame: DataFrame) -> None:
                spread = frame.select("*", bucket_of(buckets)).hint("rebalance", *FACT_PARTS)
                change.write(spread.sortWithinPartitions(*FACT_PARTS), f"{prefix}_{name}", FACT_PARTS, stale)

            with bounded_tasks(spark), ThreadPoolExecutor(WRITERS) as pool:
                for done in [pool.submit(store, *result) for result in made(change, fact).items()]:
                    done.result()
        if change.partitions("dim_trust") != change.partitions(f"{prefix}_dim_trust"):
            shown = change.read("dim_trust", TRUST_SCHEMA).select("org_code", *ORG_ATTRIBUTES)
            change.write(shown, f"{prefix}_{ATTRIBUTES}")
        for copy, table in MADE_FROM.items():
            change.tables[f"{prefix}_{copy}"] = dict(change.partitions(table))
        change.commit(**{**change.base.notes, "committed_at": change.started.isoformat(), "batch_id": change.name})
    except BaseException:
        change.abandon()
        raise
    commits.expire(spark, tables.root)
    return stale


def view_table(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """A stored view as of its last refresh, under the columns that ``gold.views`` gives it."""
    change = commits.Change(spark, tables.root)
    like = _views(change, change.read("fact", FACT_SCHEMA, ()))[name]
    return change.read(f"view_{name}", like.schema)
