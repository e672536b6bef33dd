"""Loading landings: staged rows, provider list, dimensions and fact.

A load is one change of the warehouse: staging, quarantine, dimensions and fact are written
beside what is there and become visible together, by one commit (``sources.commits``). A load
that stops anywhere leaves the former state whole. Loading the same files again changes no
fact row, so no part of the fact is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import fiscal, text
from ledgerwide.operators import dictionary, merge, quality, resolve
from ledgerwide.schemas import (
    FACT_SCHEMA,
    PROVIDER_SCHEMA,
    SCOPE,
    STAGED_SCHEMA,
    STAMPED_FACT_SCHEMA,
    STAMPED_TRUST_SCHEMA,
    TRUST_SCHEMA,
    YEAR_SCHEMA,
)
from ledgerwide.session import bounded_tasks, drop_scratch, scratch_path
from ledgerwide.sources import commits, landing, staging
from ledgerwide.sources.literal import literal_table

FACT_ORDER = ["financial_year", "worksheet_name", "org_code", "sub_code"]
FACT_PARTS = ["financial_year", "org_bucket"]

#: Rows of a staged file. Staged rows take a few bytes each, so a split of large files would hold
#: tens of millions of them, and the hash tables and sorts of its task would grow with the batch.
STAGED_FILE_ROWS = 100_000


@dataclass(frozen=True)
class Tables:
    """Folders of a warehouse.

    The fact is stored by year and bucket of organisations: a load rewrites the buckets it
    changes. More buckets suit a larger fact; their number is fixed by the first load.
    """

    root: str
    buckets: int = 16

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def staged(self) -> str:
        return self._at("staged_rows")

    @property
    def providers(self) -> str:
        return self._at("staged_providers")

    @property
    def quarantine(self) -> str:
        return self._at("quarantine")

    @property
    def trusts(self) -> str:
        return self._at("dim_trust")

    @property
    def worksheets(self) -> str:
        return self._at("dim_worksheet")

    @property
    def codes(self) -> str:
        return self._at("dim_subcode")

    @property
    def years(self) -> str:
        return self._at("dim_financial_year")

    @property
    def fact(self) -> str:
        return self._at("fact")


Scopes = Sequence[tuple[str, str]]


def scopes_of(spark: SparkSession, paths: Sequence[str]) -> Scopes:
    """(year, trust type) of landing files, as their names tell, whatever rows they hold."""
    if not paths:
        return []
    names = literal_table(spark, [(p,) for p in paths], "path string").select(landing.source_name("path").alias("n"))
    found = names.select(text.financial_year_from_name("n"), text.trust_type_from_name("n")).distinct()
    return sorted(tuple(r) for r in found.collect())


def _scope_part(scope: tuple[str, str]) -> str:
    return commits.partition(financial_year=scope[0], trust_type=scope[1])


def _within(scopes: Scopes) -> Column:
    found = F.lit(False)
    for year, kind in scopes:
        found = found | ((F.col("financial_year") == year) & (F.col("trust_type") == kind))
    return found


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("org_code"), F.lit(buckets)).cast("int").alias("org_bucket")


class _Load:
    """One batch on its way into the tables of a change."""

    def __init__(self, change: commits.Change, tables: Tables) -> None:
        self.change, self.tables, self.spark = change, tables, change.spark
        self.stamps = [F.lit(change.name).alias("batch_id"), F.lit(change.started).cast("timestamp").alias("load_ts")]
        self.buckets = change.base.notes.get("buckets", tables.buckets)

    def stage(self, rows: DataFrame, providers: DataFrame | None, scopes: Scopes, listed: Scopes) -> None:
        """Write the batch where it will stay. Landing text is parsed once, by this write.

        Every scope of the batch's files is replaced, also by nothing.
        """
        own = rows.select(*commits.columns(STAGED_SCHEMA))
        self.change.write(own, "staged_rows", SCOPE, map(_scope_part, scopes), STAGED_FILE_ROWS)
        self.rows = self.change.new("staged_rows", STAGED_SCHEMA)
        if providers is not None:
            own = providers.select(*commits.columns(PROVIDER_SCHEMA))
            self.change.write(own, "staged_providers", SCOPE, map(_scope_part, listed))
        written = [p for t in ("staged_rows", "staged_providers") for p in self.change.written.get(t, ())]
        self.parts = {*written, *map(_scope_part, scopes), *map(_scope_part, listed)}
        self.providers = self.change.read("staged_providers", PROVIDER_SCHEMA, self.parts)

    def promote(self, years: set[str]) -> None:
        """Write the tables that follow from staging. None reads another, so they go together."""
        pending = self.pending()
        steps = [
            lambda: self.fact(pending, years),
            lambda: self.change.write(
                resolve.unresolved_rows(pending, self.providers), "quarantine", SCOPE, self.parts, STAGED_FILE_ROWS
            ),
            self.trusts,
            lambda: self.labels(years),
        ]
        with ThreadPoolExecutor(len(steps)) as pool:
            for done in [pool.submit(step) for step in steps]:
                done.result()

    def pending(self) -> DataFrame:
        """Rows to resolve: those of the batch, and earlier ones whose provider list came now.

        Rows whose name no list has wait in the quarantine until a list of their scope comes.
        """
        own = {*self.change.written["staged_rows"], *self.change.tables["staged_rows"]}
        fresh = set(self.change.written["staged_rows"])
        waiting = (self.parts - fresh) & own
        held = self.change.read("quarantine", STAGED_SCHEMA, waiting)
        return self.rows.unionByName(held)

    def trusts(self) -> None:
        change = self.change
        old = change.read("dim_trust", STAMPED_TRUST_SCHEMA) if change.partitions("dim_trust") else None
        merged = merge.upsert_trusts(None if old is None else old.select(*commits.columns(TRUST_SCHEMA)), self.providers)
        stamps = [self.stamps[0], self.stamps[1].alias("updated_ts")]
        change.write(merge.stamped_trusts(merged.select(*commits.columns(TRUST_SCHEMA)), old, stamps), "dim_trust")

    def labels(self, years: set[str]) -> None:
        """Worksheets, codes and years."""
        change, spark = self.change, self.spark
        known = ref.worksheet_dimension(spark)
        if change.partitions("dim_worksheet"):
            known = change.read("dim_worksheet", ref.WORKSHEET_SCHEMA)
        change.write(resolve.add_missing_worksheets(known, self.rows), "dim_worksheet")

        if not change.partitions("dim_subcode"):
            change.write(ref.code_dimension(spark), "dim_subcode")
        seeded = fiscal.year_dimension(spark, ref.FIRST_YEAR, ref.LAST_YEAR)
        if change.partitions("dim_financial_year"):
            seeded = change.read("dim_financial_year", YEAR_SCHEMA)
        # A handful of labels; a year that the dimension lacks is added.
        missing = years - {r[0] for r in seeded.select("financial_year").collect()}
        if missing or not change.partitions("dim_financial_year"):
            starts = literal_table(spark, [(int(y[:4]),) for y in sorted(missing)], "y int")
            described = seeded.unionByName(fiscal.describe_years(starts, "y").select(*seeded.columns))
            change.write(described.select(*commits.columns(YEAR_SCHEMA)), "dim_financial_year")

    def fact(self, pending: DataFrame, years: set[str]) -> None:
        """Write the parts of the fact in which some row is new or differs, and no others."""
        change, spark = self.change, self.spark
        heads = {commits.partition(financial_year=y) for y in years}
        held = {p for p in change.partitions("fact") if p.split("/")[0] in heads}
        old = change.read("fact", STAMPED_FACT_SCHEMA, held)
        # Counted from the files' footers.
        tasks = merge.tasks_for(spark, pending.count() + (old.count() if held else 0))
        resolved = resolve.resolve_codes(pending, self.providers)
        settled = merge.settled_batch(resolved, tasks).select("*", bucket_of(self.buckets))
        if not held:
            change.write(_laid_out(settled.select("*", *self.stamps)), "fact", FACT_PARTS)
            return
        stamps = [F.col("org_bucket"), *self.stamps]
        aside = scratch_path(spark, "changes")
        try:
            # Not by part: every task would write a small file for each.
            merge.fact_changes(old, settled, stamps).write.parquet(aside)
            changes = spark.read.schema(STAMPED_FACT_SCHEMA).parquet(aside)
            # At most one row for each part.
            touched = {commits.partition(**r.asDict()) for r in changes.select(*FACT_PARTS).distinct().collect()}
            if touched:
                merged = merge.with_changes(change.read("fact", STAMPED_FACT_SCHEMA, touched), changes)
                change.write(_laid_out(merged), "fact", FACT_PARTS)
        finally:
            drop_scratch(spark, aside)


def _laid_out(fact: DataFrame) -> DataFrame:
    """Fact rows by year and bucket, sorted by schedule within a file.

    A part of the fact is one file, or several where adaptive execution finds it too large, so
    pivots combine before their shuffle and row groups of other schedules are skipped.
    """
    spread = fact.select(*commits.columns(STAMPED_FACT_SCHEMA)).hint("rebalance", *FACT_PARTS)
    return spread.sortWithinPartitions(*FACT_PARTS, *FACT_ORDER[1:])


def clustered(fact: DataFrame) -> DataFrame:
    """Fact rows laid out for the views.

    An organisation-year lies in one file, so a pivot combines it fully before its
    shuffle; within a file rows are sorted by schedule, so row groups of other
    schedules are skipped. ``rebalance`` lets adaptive execution split an
    organisation that would make one file too large.
    """
    spread = fact.hint("rebalance", "financial_year", "org_code")
    return spread.sortWithinPartitions(*FACT_ORDER)


def take_batch(
    spark: SparkSession,
    tables: Tables,
    rows: DataFrame,
    providers: DataFrame | None,
    scopes: Scopes = (),
    provider_scopes: Scopes = (),
) -> dict[str, int]:
    """Stage and promote one batch of cleaned rows; returns warning counts.

    ``scopes`` are those of the batch's files; scopes of its rows are added. Without
    ``providers`` the lists of earlier loads hold. Nothing is visible before the last step.
    """
    for path in (tables.trusts, tables.worksheets):
        staging.recover(spark, path)
    change = commits.Change(spark, tables.root)
    load_ = _Load(change, tables)
    try:
        with bounded_tasks(spark):
            load_.stage(rows, providers, scopes, provider_scopes)
            warnings = quality.assert_loadable(load_.rows, load_.providers)
            load_.promote({_year_of(p) for p in load_.parts})
        change.commit(scopes=", ".join(sorted(load_.parts)), buckets=load_.buckets)
    except BaseException:
        change.abandon()
        raise
    commits.expire(spark, tables.root)
    return warnings


def _year_of(part: str) -> str:
    return part.split("/")[0].removeprefix("financial_year=").replace("%2F", "/")


def load(
    spark: SparkSession,
    tables: Tables,
    statement_files: Sequence[str],
    provider_files: Sequence[str],
    file_format: str = "csv",
) -> dict[str, int]:
    """Load landing files end to end; returns warning counts.

    Provider lists and statements may come in any order and apart from each other.
    """
    if not statement_files and not provider_files:
        raise ValueError("no landing files")
    rows = literal_table(spark, [], STAGED_SCHEMA)
    if statement_files:
        rows = landing.read_statement_rows(spark, statement_files, file_format)
    providers = landing.read_provider_list(spark, provider_files, file_format) if provider_files else None
    scopes, listed = scopes_of(spark, statement_files), scopes_of(spark, provider_files)
    return take_batch(spark, tables, rows, providers, scopes, listed)


def load_folder(
    spark: SparkSession, tables: Tables, statements: str, providers: str, file_format: str = "csv"
) -> dict[str, int]:
    """Discover the landings of two folders and load them."""
    files = [[r["path"] for r in landing.discover_files(spark, f).collect()] for f in (statements, providers)]
    return load(spark, tables, *files, file_format)


def extend_codes(spark: SparkSession, tables: Tables, grid: DataFrame) -> None:
    """Add the codes of template sheets to the stored code dimension; curated rows stay."""
    change = commits.Change(spark, tables.root)
    try:
        known = ref.code_dimension(spark)
        if change.partitions("dim_subcode"):
            known = change.read("dim_subcode", ref.CODE_SCHEMA)
        change.write(dictionary.extend_codes(known, dictionary.extract_codes(grid)), "dim_subcode")
        change.commit(**change.base.notes | {"batch_id": change.name, "committed_at": change.started.isoformat()})
    except BaseException:
        change.abandon()
        raise


def fact_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.fact, FACT_SCHEMA)


def stamped_fact_table(spark: SparkSession, tables: Tables) -> DataFrame:
    """The fact with the batch that wrote a row last and its time."""
    return staging.read_table(spark, tables.fact, STAMPED_FACT_SCHEMA)


def trust_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.trusts, TRUST_SCHEMA)


def stamped_trust_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.trusts, STAMPED_TRUST_SCHEMA)


def worksheet_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.worksheets, ref.WORKSHEET_SCHEMA)


def code_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.codes, ref.CODE_SCHEMA)


def year_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return staging.read_table(spark, tables.years, YEAR_SCHEMA)


def quarantine_table(spark: SparkSession, tables: Tables) -> DataFrame:
    """Staged rows whose organisation no provider list of their scope names so far."""
    return staging.read_table(spark, tables.quarantine, STAGED_SCHEMA)
