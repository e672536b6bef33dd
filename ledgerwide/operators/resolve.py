"""Names to codes, and rows without a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME_KEYS = ["organisation_name", "financial_year", "trust_type"]

BROADCAST_NAMES = 400_000  # names without a provider that are sent to every task, some 100 bytes each


def resolve_codes(staged: DataFrame, providers: DataFrame) -> DataFrame:
    """Staged rows with the provider's code; rows of unlisted names drop out.

    Names match whatever their case. Providers are made distinct first so that a
    name listed twice does not multiply rows. There is no broadcast hint, since the list
    grows with the landings. A task holds its share of the list in a hash table and its rows
    stream by unsorted; a name that holds much of the data is split (skew join).
    """
    name = F.lower("organisation_name").alias("_name")
    scope = ["_name", "financial_year", "trust_type"]
    listed = providers.select(name, "financial_year", "trust_type", "org_code").distinct()
    joined = staged.withColumn("_name", F.lower("organisation_name")).join(listed.hint("shuffle_hash"), scope, "inner")
    return joined.select(
        "org_code", "financial_year", "worksheet_name", "table_id", "main_code", "sub_code",
        F.col("total").alias("total_000s"), "trust_type", "source_file", "row_num",
    )


def unresolved_rows(staged: DataFrame, providers: DataFrame) -> DataFrame:
    """Staged rows that ``resolve_codes`` drops, because no provider of their scope has the name.

    Names are looked up first, each once. Up to ``BROADCAST_NAMES`` without a provider are sent
    to the rows, which then do not move; more of them meet the rows in a hash join.
    """
    name = F.lower("organisation_name").alias("_name")
    scope = ["_name", "financial_year", "trust_type"]
    listed = providers.where("org_code is not null").select(name, "financial_year", "trust_type").distinct()
    names = staged.select(name, "financial_year", "trust_type").distinct()
    missing = names.join(listed.hint("shuffle_hash"), scope, "left_anti")
    way = "broadcast" if missing.count() <= BROADCAST_NAMES else "shuffle_hash"
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in scope]
    rows = staged.withColumn("_name", name).alias("r")
    return rows.join(missing.hint(way).alias("m"), same, "left_semi").select(*staged.columns)


def unmatched_names(staged: DataFrame, providers: DataFrame) -> DataFrame:
    """Distinct staged names (per year and type) missing from the provider list as spelled."""
    names = staged.select(*NAME_KEYS).distinct()
    return names.join(providers.select(*NAME_KEYS), NAME_KEYS, "left_anti")


def orphan_codes(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    """Distinct fact codes without an organisation. Distinct comes first: few rows are joined."""
    return fact.select("org_code").distinct().join(trusts, "org_code", "left_anti")


def orphan_count(fact: DataFrame, trusts: DataFrame) -> DataFrame:
    return orphan_codes(fact, trusts).agg(F.count("org_code").alias("orphans"))


def add_missing_worksheets(worksheets: DataFrame, rows: DataFrame) -> DataFrame:
    """The worksheet dimension plus names it lacks, titled by name, category OTHER."""
    new = (
        rows.select("worksheet_name")
        .where("worksheet_name IS NOT NULL")
        .distinct()
        .join(worksheets, "worksheet_name", "left_anti")
        .select(
            "worksheet_name",
            F.col("worksheet_name").alias("schedule_title"),
            F.lit("OTHER").alias("category"),
            F.lit(None).cast("string").alias("sub_code_prefix"),
        )
    )
    return worksheets.unionByName(new)


def known_rows(fact: DataFrame, trusts: DataFrame, codes: DataFrame, columns: list[Column]) -> DataFrame:
    """Star join of the fact with both dimensions; rows missing either drop out."""
    places = trusts.select("org_code", "organisation_name", "sector", "region", F.col("trust_type"))
    labels = codes.select("sub_code", "description", "is_subtotal", "analytics_category")
    return fact.join(labels, "sub_code").join(places, "org_code").select(*columns)
