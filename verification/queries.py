"""Every registered query. Keys start with the operator's id.

All inputs are the given tables or tables Spark derives from them, whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import fiscal, status, text
from ledgerwide.functions import numeric as num
from ledgerwide.operators import (
    benchmarks,
    detail,
    dictionary,
    enrich,
    measures,
    merge,
    plan_kpis,
    quality,
    ranking,
    resolve,
    yoy,
)
from ledgerwide.plans import checks, exports, gold, load, peers, stored_checks, stored_views, trends
from ledgerwide.schemas import ORG_YEAR, STAGED_SCHEMA, VIEW_KEY
from ledgerwide.session import scratch_path
from ledgerwide.sources import catalog, derived, landing, sinks, staging
from ledgerwide.streaming.incremental import load_new_files

YEAR = derived.CURRENT_YEAR
YEARS = derived.YEARS
RELOAD_SCOPE = ("2000/01", "NHS_TRUST")

EXPECT = quality.Expectations(
    fact_rows_min=2_000,
    trusts_min=5,
    years=[*YEARS, "2010/11"],
    year=YEAR,
    income_bn=(0.001, 1_000_000),
    deficits=(1, 1_000_000_000),
    ebitda_pct=(2.0, 6.0),
    pay_pct=(60, 75),
)


class Inputs:
    """The derived tables of one folder, built on first use (lazy plans, nothing cached)."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.folder, name)

    @cached_property
    def fact(self) -> DataFrame:
        return derived.fact(self.spark, self.folder)

    @cached_property
    def trusts(self) -> DataFrame:
        return derived.trusts(self.spark, self.folder)

    @cached_property
    def codes(self) -> DataFrame:
        return ref.code_dimension(self.spark)

    @cached_property
    def card(self) -> DataFrame:
        return gold.scorecard(self.fact, self.trusts, self.codes)

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.kpis(self.fact, self.trusts, self.codes)

    @cached_property
    def summary(self) -> DataFrame:
        return gold.income_expenditure(self.fact, self.trusts)

    @cached_property
    def breakdown(self) -> DataFrame:
        return gold.expenditure_breakdown(self.fact, self.trusts, self.codes)

    @cached_property
    def staff(self) -> DataFrame:
        return gold.workforce(self.fact, self.trusts)

    @cached_property
    def base(self) -> DataFrame:
        return gold.measure_base(self.fact, self.trusts, self.codes)

    @cached_property
    def enriched(self) -> DataFrame:
        return exports.enriched_scorecard(self.warehouse)

    @cached_property
    def staged(self) -> DataFrame:
        return landing.stage_rows(derived.raw_rows(self.spark, self.folder))

    @cached_property
    def providers(self) -> DataFrame:
        return landing.stage_providers(derived.raw_providers(self.spark, self.folder))

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve.resolve_codes(self.staged, self.providers)

    @cached_property
    def year_dimension(self) -> DataFrame:
        starts = self.table("lineitem").select(fiscal.start_year("l_shipdate").alias("y")).distinct()
        return fiscal.describe_years(starts, "y", complete_to=2000)

    @cached_property
    def warehouse(self) -> exports.Warehouse:
        seen = self.fact.groupBy("org_code").agg(
            F.min("financial_year").alias("first_year_seen"),
            F.max("financial_year").alias("last_year_seen"),
        )
        trusts = self.trusts.join(seen, "org_code", "left")
        return exports.Warehouse(self.fact, trusts, self.codes, self.year_dimension)


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


# --- sources and sinks -------------------------------------------------------------


@query("S1_discover_files")
def _(t: Inputs) -> DataFrame:
    """A landing of folders of parts below an illustrative parent, with strangers beside them."""
    names = derived.base_sums(t.spark, t.folder).select(
        derived.source_file("l_suppkey", "fy").alias("n")
    ).distinct()
    odd = F.array("n", F.replace("n", F.lit("NHS_"), F.lit("NHS_Illustrative_")), F.concat(F.lit("other_"), "n"))
    root = f"{scratch_path(t.spark, 'discover')}/Illustrative_set"
    candidates = names.select(F.explode(odd).alias("source_file"), F.lit("x").alias("x"))
    candidates.write.partitionBy("source_file").csv(root)
    found = landing.discover_files(t.spark, root)
    return found.select(F.concat(F.lit("raw/"), landing.source_name("path")).alias("path"))


@query("S2_read_provider_list")
def _(t: Inputs) -> DataFrame:
    return t.providers


@query("S3_find_sheet_name")
def _(t: Inputs) -> DataFrame:
    odd = t.table("supplier").toDF("S_SUPPKEY ", "S_Name", "s_nationkey", "s_acctbal")
    key, name = (landing.find_name(odd.columns, c) for c in ("s_suppkey", " s_name"))
    return odd.select(F.col(f"`{key}`").alias("supplier_key"), F.col(name).alias("supplier_name"))


@query("S4_read_all_data")
def _(t: Inputs) -> DataFrame:
    return t.staged


@query("S4b_mixed_headers")
def _(t: Inputs) -> DataFrame:
    """CSV files and parts of Parquet landings that carry different headers and types."""
    files = derived.write_mixed_landing(t.spark, t.folder, scratch_path(t.spark, "mixed"))
    csv, parquet = (
        landing.read_statement_rows(t.spark, files[kind], kind).withColumn("form", F.lit(kind)) for kind in ("csv", "parquet")
    )
    return csv.unionByName(parquet)


@query("S5_sql_scan")
def _(t: Inputs) -> DataFrame:
    t.fact.createOrReplaceTempView("ledgerwide_fact")
    return catalog.sql_scan(
        t.spark,
        "SELECT org_code, main_code, sub_code, total_000s FROM ledgerwide_fact "
        "WHERE financial_year = :fy AND trust_type = :tt",
        fy=YEAR,
        tt=text.NHS_TRUST,
    )


@query("S6_load_staging")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "staging")
    staging.overwrite_scopes(t.staged, path)
    year, kind = RELOAD_SCOPE
    reload = t.staged.where(
        (F.col("financial_year") == year) & (F.col("trust_type") == kind) & (F.col("total") > 0)
    )
    staging.overwrite_scopes(reload, path)
    return staging.read_table(t.spark, path, STAGED_SCHEMA)


@query("S6b_emptied_scope")
def _(t: Inputs) -> DataFrame:
    """Staging after a reload in which the file of one scope holds prior-year rows alone."""
    tables = load.Tables(scratch_path(t.spark, "emptied"))
    load.take_batch(t.spark, tables, t.staged, t.providers)
    load.take_batch(t.spark, tables, t.staged.limit(0), None, [RELOAD_SCOPE])
    return staging.read_table(t.spark, tables.staged, STAGED_SCHEMA)


@query("S7_export_query")
def _(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "export")
    frame = exports.EXPORTS["ie_summary"].frame(t.warehouse)
    sinks.write_csv(frame, path)
    types = dict(frame.dtypes)
    back = t.spark.read.option("header", True).csv(path)
    names = [c.lstrip(sinks.BYTE_ORDER_MARK) for c in back.columns]
    return back.toDF(*names).select(*(F.col(c).cast(types[c]).alias(c) for c in names))


@query("S8_csv_exports")
def _(t: Inputs) -> DataFrame:
    """All eleven datasets written and read back: rows and columns of each."""
    root = scratch_path(t.spark, "exports")
    exports.write_exports(t.warehouse, root)
    parts = []
    for name in exports.EXPORTS:
        back = t.spark.read.option("header", True).csv(f"{root}/{name}.csv")
        parts.append(
            back.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("dataset"),
                "row_count",
                F.lit(len(back.columns)).alias("column_count"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("S8b_export_contents")
def _(t: Inputs) -> DataFrame:
    """Every column of the eleven written datasets, by its values as they stand in the files."""
    root = scratch_path(t.spark, "contents")
    exports.write_exports(t.warehouse, root)
    parts = []
    for name in exports.EXPORTS:
        back = t.spark.read.option("header", True).csv(f"{root}/{name}.csv")
        back = back.toDF(*[c.lstrip(sinks.BYTE_ORDER_MARK) for c in back.columns])
        cells = back.unpivot([], list(back.columns), "column_name", "cell").where("cell is not null")
        parts.append(cells.select(F.lit(name).alias("dataset"), "column_name", "cell"))
    word = F.conv(F.substring(F.md5("cell"), 1, 8), 16, 10).cast("bigint")
    return reduce(DataFrame.unionByName, parts).groupBy("dataset", "column_name").agg(
        F.count("*").alias("cells"), F.sum(word).alias("checksum")
    )


@query("S9_validation_report")
def _(t: Inputs) -> DataFrame:
    report = quality.run_checks(quality.all_checks(t.fact, t.trusts, t.base, EXPECT))
    path = scratch_path(t.spark, "report")
    sinks.write_csv(report.frame(t.spark), path, byte_order_mark=False)
    back = t.spark.read.schema(quality.REPORT_SCHEMA).option("header", True).csv(path)
    return back.drop("run_ts")


@query("S10_build_reference")
def _(t: Inputs) -> DataFrame:
    found = dictionary.extract_codes(derived.template_grid(t.spark, t.folder))
    return dictionary.extend_codes(t.codes, found)


@query("S11_seed_dimensions")
def _(t: Inputs) -> DataFrame:
    """Fact rows under each seeded schedule and year."""
    rows = t.fact.groupBy("worksheet_name", "financial_year").agg(F.count("*").alias("fact_rows"))
    return (
        rows.join(ref.worksheet_dimension(t.spark), "worksheet_name")
        .join(t.year_dimension, "financial_year")
        .select("schedule_title", "category", "sub_code_prefix", "year_label_short", "start_date",
                "end_date", "is_complete", "fact_rows")
    )


@query("S11b_stored_codes")
def _(t: Inputs) -> DataFrame:
    """The code dimension as the first load stores it, extended from template sheets twice."""
    tables = load.Tables(scratch_path(t.spark, "codes"))
    load.take_batch(t.spark, tables, t.staged, t.providers)
    for _run in range(2):
        load.extend_codes(t.spark, tables, derived.template_grid(t.spark, t.folder))
    return load.code_table(t.spark, tables)


@query("S11c_stored_years")
def _(t: Inputs) -> DataFrame:
    """The year dimension with the years that two loads brought."""
    tables = load.Tables(scratch_path(t.spark, "years"))
    early = F.col("financial_year") < "1998"
    load.take_batch(t.spark, tables, t.staged.where(early), t.providers.where(early))
    load.take_batch(t.spark, tables, t.staged.where(~early), t.providers.where(~early))
    return load.year_table(t.spark, tables)


# --- projections and scalar functions -----------------------------------------------


def _file_names(t: Inputs) -> DataFrame:
    return derived.base_sums(t.spark, t.folder).select(
        "l_suppkey", "fy", derived.source_file("l_suppkey", "fy").alias("source_file")
    )


@query("P1_financial_year_from_name")
def _(t: Inputs) -> DataFrame:
    return _file_names(t).select(
        "l_suppkey", "fy", text.financial_year_from_name("source_file").alias("financial_year")
    )


@query("P2_trust_type_from_name")
def _(t: Inputs) -> DataFrame:
    return _file_names(t).select(
        "l_suppkey", "fy", text.trust_type_from_name("source_file").alias("trust_type")
    )


@query("P3_year_type")
def _(t: Inputs) -> DataFrame:
    return (
        t.fact.groupBy(
            text.year_type("main_code").alias("year_type"),
            text.is_current_year("main_code").alias("is_current"),
        )
        .agg(F.count("*").alias("n"))
    )


@query("P4_clean_and_coerce")
def _(t: Inputs) -> DataFrame:
    raw = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.when(F.col("l_linenumber") == 7, "n/a")
        .otherwise((-F.col("l_extendedprice")).cast("string")).alias("amount"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("flag"),
    )
    return raw.na.drop(subset=["amount"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        num.truncate_to_integer("amount").alias("amount"), landing.clean_text("flag").alias("flag"),
    )


@query("P5_normalise_sectors")
def _(t: Inputs) -> DataFrame:
    return enrich.normalise_sectors(t.trusts).select("org_code", "sector")


@query("P6_is_large")
def _(t: Inputs) -> DataFrame:
    return t.card.select(*ORG_YEAR, status.is_large("total_income_000s").alias("is_large"))


@query("P7_pay_pressure_flag")
def _(t: Inputs) -> DataFrame:
    return t.card.select(
        *ORG_YEAR,
        status.pay_pressure_flag("pay_pct_income", "sector").alias("strict_flag"),
        status.pay_pressure_flag("pay_pct_income", "sector", status.PAY_AMBER_DEFAULT).alias(
            "default_flag"
        ),
    )


@query("P8_income_mix")
def _(t: Inputs) -> DataFrame:
    return enrich.add_income_mix(t.card).select(*ORG_YEAR, "patient_income_pct", "other_income_pct")


@query("P9_fiscal_year")
def _(t: Inputs) -> DataFrame:
    starts = t.table("orders").select(fiscal.start_year("o_orderdate").alias("y")).distinct()
    return fiscal.describe_years(starts, "y", complete_to=2000)


@query("P10_period_and_quarter")
def _(t: Inputs) -> DataFrame:
    return (
        t.table("orders")
        .groupBy(
            fiscal.label("o_orderdate").alias("financial_year"),
            fiscal.period("o_orderdate").alias("period"),
            fiscal.quarter("o_orderdate").alias("quarter"),
        )
        .agg(F.count("*").alias("n"))
    )


@query("P11_case_when")
def _(t: Inputs) -> DataFrame:
    return t.card.select(
        *ORG_YEAR,
        status.pay_threshold("sector").alias("threshold"),
        text.deficit_text("is_deficit").alias("status"),
        "ebitda_rag",
        "surplus_rag",
    )


@query("P12_null_handling")
def _(t: Inputs) -> DataFrame:
    return t.summary.select(
        *ORG_YEAR,
        F.coalesce("patient_care_income_000s", F.lit(0)).alias("patient_or_zero"),
        F.nullif(F.col("total_income_000s"), F.lit(0)).alias("income_or_null"),
        F.abs("net_surplus_000s").alias("net_size"),
    )


@query("P13_rounding")
def _(t: Inputs) -> DataFrame:
    eighth = F.col("l_quantity") / 8
    return t.table("lineitem").groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("n")).select(
        "l_suppkey", "l_quantity", "n",
        F.round(eighth, 2).alias("half_up"),
        num.half_even(eighth, 2).alias("half_even"),
    )


@query("P14_thousands_text")
def _(t: Inputs) -> DataFrame:
    return t.card.select(
        *ORG_YEAR,
        trends.row_millions_text("total_income_000s").alias("income_m"),
        trends.row_millions_text("operating_surplus_000s", 1).alias("surplus_m"),
        "operating_surplus_000s",
    )


@query("P15_concatenated_text")
def _(t: Inputs) -> DataFrame:
    return t.enriched.select(
        *ORG_YEAR,
        text.percent_text("ebitda_margin_pct").alias("margin"),
        text.signed_points_text("ebitda_margin_yoy_pp").alias("change"),
    )


@query("P16_whole_numbers")
def _(t: Inputs) -> DataFrame:
    amounts = t.summary.select(
        *ORG_YEAR, *(F.col(c).cast("decimal(14,0)").alias(c) for c in ("total_income_000s", "net_surplus_000s"))
    )
    return amounts.select(*ORG_YEAR, *exports.whole(["total_income_000s", "net_surplus_000s"]))


@query("P17_predicates")
def _(t: Inputs) -> DataFrame:
    return t.fact.where(
        F.col("worksheet_name").isin(ref.SOCI, ref.EXPENDITURE)
        & F.col("total_000s").between(-1_000_000, 1_000_000)
        & F.col("sub_code").like("%0A")
        & F.col("source_file").isNotNull()
        & (F.length(F.trim("sub_code")) == 8)
    ).select("org_code", "financial_year", "main_code", "sub_code", "total_000s")


@query("P18_unit_rescale")
def _(t: Inputs) -> DataFrame:
    return t.card.select(
        *ORG_YEAR,
        num.in_units("total_income_000s", num.MILLIONS).alias("income_m"),
        num.in_units("total_income_000s", num.BILLIONS).alias("income_bn"),
    )


@query("P19_column_pruning")
def _(t: Inputs) -> DataFrame:
    return t.enriched.select(*enrich.INCOME_EXPORT)


# --- joins ----------------------------------------------------------------------------


@query("J1_resolve_codes")
def _(t: Inputs) -> DataFrame:
    return t.resolved


@query("J2_unmatched_names")
def _(t: Inputs) -> DataFrame:
    return resolve.unmatched_names(t.staged, t.providers)


@query("J3_fact_with_trust")
def _(t: Inputs) -> DataFrame:
    per_org = t.fact.groupBy("org_code", "worksheet_name").agg(
        F.count("*").alias("n"), F.sum("total_000s").alias("total_000s")
    )
    return (
        per_org.join(t.trusts, "org_code")
        .groupBy("region", "worksheet_name")
        .agg(F.sum("n").alias("n"), F.sum("total_000s").alias("total_000s"))
    )


@query("J4_fact_with_trust_and_code")
def _(t: Inputs) -> DataFrame:
    rows = resolve.known_rows(
        t.fact.drop("trust_type"), t.trusts, t.codes,
        ["org_code", "sector", "analytics_category", "is_subtotal", "total_000s"],
    )
    return rows.groupBy("sector", "analytics_category", "is_subtotal").agg(
        F.count("*").alias("n"), F.sum("total_000s").alias("total_000s")
    )


@query("J5_kpi_join")
def _(t: Inputs) -> DataFrame:
    wide = gold.org_year_wide(t.fact, t.trusts, t.codes).where("has_summary")
    return wide.select(*ORG_YEAR, "total_income_000s", "pay_000s", "depreciation_amort_000s", "total_wte")


@query("J6_scorecard_lines")
def _(t: Inputs) -> DataFrame:
    return t.card.select(*ORG_YEAR, *ref.SCORECARD_LINES.values())


@query("J7_year_pairs")
def _(t: Inputs) -> DataFrame:
    return yoy.year_pair(
        t.card, "org_code", YEAR, fiscal.shift_label(YEAR, -1),
        keep=["organisation_name", "is_deficit"], compare=["ebitda_margin_pct", "total_income_000s"],
    )


@query("J8_orphan_facts")
def _(t: Inputs) -> DataFrame:
    return resolve.orphan_count(t.fact, t.trusts)


@query("J9_missing_worksheets")
def _(t: Inputs) -> DataFrame:
    return resolve.add_missing_worksheets(ref.worksheet_dimension(t.spark), t.staged)


# --- upserts ----------------------------------------------------------------------------


@query("M1_fact_upsert")
def _(t: Inputs) -> DataFrame:
    first = merge.upsert_fact(None, t.resolved)
    reload = t.resolved.where(F.col("trust_type") == text.NHS_TRUST).withColumns(
        {
            "total_000s": F.col("total_000s") + F.col("row_num"),
            "worksheet_name": F.lit("changed"),
            "source_file": F.concat(F.lit("reload_"), "source_file"),
        }
    )
    return merge.upsert_fact(first, reload)


@query("M2_trust_upsert")
def _(t: Inputs) -> DataFrame:
    early = F.col("financial_year") < "1998"
    existing = merge.upsert_trusts(None, t.providers.where(early))
    renamed = t.providers.where(~early).withColumn(
        "organisation_name", F.concat("organisation_name", F.lit(" renamed"))
    )
    return merge.upsert_trusts(existing, renamed)


@query("M3_reload_is_idempotent")
def _(t: Inputs) -> DataFrame:
    return merge.upsert_fact(merge.upsert_fact(None, t.resolved), t.resolved)


@query("M4_load_files_twice")
def _(t: Inputs) -> DataFrame:
    """The whole load from CSV files, run twice: landing, staging, dimensions and fact tables."""
    root = scratch_path(t.spark, "load")
    files = derived.write_landing(t.spark, t.folder, f"{root}/landing")
    tables = load.Tables(f"{root}/warehouse")
    for _run in range(2):
        load.load(t.spark, tables, *files)
    return load.fact_table(t.spark, tables)


@query("M5_stream_load")
def _(t: Inputs) -> DataFrame:
    """The same load as a stream over the landing folder."""
    root = scratch_path(t.spark, "stream")
    files, lists = derived.write_landing(t.spark, t.folder, f"{root}/landing")
    headers = ", ".join(f"`{c}` string" for c in landing.csv_header(t.spark, files[0]))
    tables = load.Tables(f"{root}/warehouse")
    stream = load_new_files(
        t.spark, f"{root}/landing/rows", tables, landing.read_provider_list(t.spark, lists),
        f"{root}/checkpoint", headers, "csv",
    )
    stream.awaitTermination()
    return load.fact_table(t.spark, tables)


@query("M6_stream_late_providers")
def _(t: Inputs) -> DataFrame:
    """Statements streamed before any provider list; the lists, streamed later, release them."""
    root = scratch_path(t.spark, "late")
    derived.write_landing(t.spark, t.folder, f"{root}/landing")
    tables = load.Tables(f"{root}/warehouse")
    watched = f"{root}/watched"
    t.spark.createDataFrame([], "x string").write.csv(watched)
    for lists in (watched, f"{root}/landing/providers"):
        stream = load_new_files(t.spark, f"{root}/landing/rows", tables, lists, f"{root}/checkpoint", file_format="csv")
        stream.awaitTermination()
    return load.fact_table(t.spark, tables)


@query("M7_load_mixed_headers")
def _(t: Inputs) -> DataFrame:
    """The whole load from Parquet landings whose parts carry different headers."""
    root = scratch_path(t.spark, "mixed-load")
    rows = derived.write_mixed_landing(t.spark, t.folder, f"{root}/landing")["parquet"]
    lists = derived.write_provider_landing(t.spark, t.folder, f"{root}/landing")
    tables = load.Tables(f"{root}/warehouse")
    load.load(t.spark, tables, rows, lists, "parquet")
    return load.fact_table(t.spark, tables)


@query("M8_refused_load")
def _(t: Inputs) -> DataFrame:
    """Staging and fact after a load whose batch is refused: those of the load before it."""
    tables = load.Tables(scratch_path(t.spark, "refused"))
    load.take_batch(t.spark, tables, t.staged, t.providers)
    bad = t.staged.withColumns({"total": F.col("total") + 1, "sub_code": F.when(F.col("row_num") % 2 == 0, F.col("sub_code"))})
    try:
        load.take_batch(t.spark, tables, bad, t.providers)
    except ValueError:
        pass
    else:
        raise AssertionError("a batch with null codes was loaded")
    staged = staging.read_table(t.spark, tables.staged, STAGED_SCHEMA)
    parts = [f.agg(F.count("*").alias("n"), F.sum(c).alias("total_000s")).withColumn("name", F.lit(name))
             for name, f, c in (("staged", staged, "total"), ("fact", load.fact_table(t.spark, tables), "total_000s"))]
    return parts[0].unionByName(parts[1])


@query("M9_quarantine")
def _(t: Inputs) -> DataFrame:
    """Rows that wait after a load with the provider lists of one trust type alone."""
    tables = load.Tables(scratch_path(t.spark, "quarantine"))
    load.take_batch(t.spark, tables, t.staged, t.providers.where(F.col("trust_type") == text.NHS_TRUST))
    return load.quarantine_table(t.spark, tables)


@query("M10_changed_rows")
def _(t: Inputs) -> DataFrame:
    """Fact rows by the load that wrote them last: the first, or a reload that corrects some."""
    tables = load.Tables(scratch_path(t.spark, "stamps"))
    load.take_batch(t.spark, tables, t.staged, t.providers)
    fixed = F.when(F.col("main_code").endswith("01"), F.col("total") + 1).otherwise(F.col("total"))
    load.take_batch(t.spark, tables, t.staged.withColumn("total", fixed), t.providers)
    newest = F.max("batch_id").over(Window.partitionBy(F.lit(1)))
    rows = load.stamped_fact_table(t.spark, tables).groupBy("main_code", "batch_id").agg(F.count("*").alias("n"))
    return rows.select("main_code", "n", (F.col("batch_id") == newest).alias("rewritten"))


# --- views --------------------------------------------------------------------------------


@query("V1_income_expenditure")
def _(t: Inputs) -> DataFrame:
    return t.summary


@query("V2_profit_and_loss")
def _(t: Inputs) -> DataFrame:
    return gold.profit_and_loss(t.fact, t.trusts)


@query("V3_expenditure_breakdown")
def _(t: Inputs) -> DataFrame:
    return t.breakdown


@query("V4_workforce")
def _(t: Inputs) -> DataFrame:
    return t.staff


@query("V5_balance_sheet")
def _(t: Inputs) -> DataFrame:
    return gold.balance_sheet(t.fact, t.trusts)


@query("V6_kpis")
def _(t: Inputs) -> DataFrame:
    return t.kpis


@query("V7_annual_scorecard")
def _(t: Inputs) -> DataFrame:
    return t.card


@query("V8_strict_income_variant")
def _(t: Inputs) -> DataFrame:
    return gold.income_expenditure(t.fact, t.trusts, coalesce_patient_income=False)


@query("V9_stored_views")
def _(t: Inputs) -> DataFrame:
    """A stored view after a load with wrong amounts in one scope, a refresh, the right file, and a refresh."""
    tables = load.Tables(scratch_path(t.spark, "views"))
    year, kind = RELOAD_SCOPE
    hit = (F.col("financial_year") == year) & (F.col("trust_type") == kind)
    wrong = t.staged.withColumn("total", F.when(hit, -F.col("total") - 7).otherwise(F.col("total")))
    load.take_batch(t.spark, tables, wrong, t.providers)
    stored_views.refresh(t.spark, tables)
    load.take_batch(t.spark, tables, t.staged.where(hit), None)
    stored_views.refresh(t.spark, tables)
    view = stored_views.view_table(t.spark, tables, "income_expenditure")
    return view.drop("organisation_name", "sector", "region", "trust_type")


# --- aggregations ---------------------------------------------------------------------------


@query("A1_basic_aggregates")
def _(t: Inputs) -> DataFrame:
    income = F.col("total_income_000s")
    return t.card.groupBy("sector", "region").agg(
        F.sum(income).alias("sum_income"), num.exact_mean("ebitda_margin_pct").alias("avg_margin"),
        F.min(income).alias("min_income"), F.max(income).alias("max_income"),
        F.count("*").alias("n"),
    )


@query("A2_distinct_counts")
def _(t: Inputs) -> DataFrame:
    keys = F.concat_ws("|", "org_code", "main_code", "sub_code")
    return t.fact.groupBy("financial_year").agg(F.count_distinct(keys).alias("distinct_keys"))


@query("A3_conditional_aggregates")
def _(t: Inputs) -> DataFrame:
    surplus = F.col("operating_surplus_000s")
    return t.summary.groupBy("financial_year").agg(
        num.count_if(surplus < 0).alias("deficits"),
        num.count_if(surplus >= 0).alias("surpluses"),
        num.sum_if(surplus < 0, surplus).alias("deficit_000s"),
    )


@query("A4_year_pivot")
def _(t: Inputs) -> DataFrame:
    pivoted = trends.region_pivot(t.card, YEARS)
    return pivoted.select("region", *(F.col(f"`{y}`").alias(f"y{y[:4]}") for y in YEARS))


@query("A5_weighted_and_mean_ratios")
def _(t: Inputs) -> DataFrame:
    return t.card.groupBy("financial_year", "trust_type").agg(
        trends.share_of_income("pay_000s", 2).alias("weighted_pct"),
        trends.mean_share_of_income("pay_000s", 2).alias("mean_pct"),
    )


@query("A6_repeated_keys")
def _(t: Inputs) -> DataFrame:
    return quality.repeated_keys(t.resolved)


@query("A7_sector_benchmarks")
def _(t: Inputs) -> DataFrame:
    return benchmarks.sector_benchmarks(t.enriched)


@query("A7b_median_of_any_spread")
def _(t: Inputs) -> DataFrame:
    return benchmarks.quantile_of_any_spread(
        t.enriched, ["financial_year", "sector"], "total_income_000s", 0.5, 0, "median_income_000s"
    )


@query("A8_benchmark_export")
def _(t: Inputs) -> DataFrame:
    return benchmarks.benchmark_export(t.kpis)


@query("A9_global_aggregate")
def _(t: Inputs) -> DataFrame:
    return t.fact.agg(
        F.count("*").alias("fact_rows"), F.sum("total_000s").alias("total_000s"),
        F.min("financial_year").alias("first_year"), F.max("financial_year").alias("last_year"),
    )


@query("A10_repeated_rows")
def _(t: Inputs) -> DataFrame:
    return quality.batch_problems(t.staged).select("repeated_rows")


@query("A11_distinct_rows")
def _(t: Inputs) -> DataFrame:
    return t.staged.select("worksheet_name", "main_code", "financial_year").distinct()


# --- windows, order, limit --------------------------------------------------------------------


@query("W1_income_quartiles")
def _(t: Inputs) -> DataFrame:
    card = t.card.select(*ORG_YEAR, "total_income_000s")
    return peers.income_quartiles(card)


@query("W2_rank_of_top_rows")
def _(t: Inputs) -> DataFrame:
    order = [F.col("net_surplus_margin_pct").asc_nulls_first()]
    rows = t.card.select(*ORG_YEAR, "net_surplus_margin_pct").withColumn(
        "row_key", F.concat("org_code", "financial_year")
    )
    return ranking.top_ranked(rows, order, "row_key", 40, "margin_rank").drop("row_key")


@query("W3_previous_row_and_year")
def _(t: Inputs) -> DataFrame:
    return t.card.select(
        *ORG_YEAR,
        yoy.prior_row("ebitda_margin_pct").alias("previous_row_pct"),
        yoy.prior_year("ebitda_margin_pct", ["org_code"]).alias("previous_year_pct"),
    )


@query("W4_year_to_date")
def _(t: Inputs) -> DataFrame:
    monthly = (
        t.table("orders")
        .groupBy(
            "o_orderpriority",
            fiscal.label("o_orderdate").alias("financial_year"),
            fiscal.period("o_orderdate").alias("period"),
        )
        .agg(F.count("*").alias("orders"))
    )
    keys = ["o_orderpriority", "financial_year"]
    return monthly.withColumn("ytd_orders", yoy.year_to_date("orders", keys, "period"))


@query("W5_multi_key_order")
def _(t: Inputs) -> DataFrame:
    return t.summary.select(*ORG_YEAR, "total_income_000s").orderBy(
        "financial_year", F.col("total_income_000s").desc(), "org_code"
    )


@query("W6_top_k")
def _(t: Inputs) -> DataFrame:
    rows = t.summary.select(
        *ORG_YEAR, "net_surplus_000s", F.concat("org_code", "financial_year").alias("row_key")
    )
    return ranking.top(rows, [F.col("net_surplus_000s").asc_nulls_first()], "row_key", 25)


# --- named analyses ------------------------------------------------------------------------------

QUERIES.update(
    {
        "T1_national_trend": lambda t: trends.national_trend(t.card),
        "T2_sector_comparison": lambda t: trends.sector_comparison(t.card, YEAR),
        "T3_region_growth": lambda t: trends.region_growth(t.card, YEARS),
        "T4_ebitda_distribution": lambda t: trends.ebitda_distribution(t.card, YEAR),
        "T5_largest_by_income": lambda t: trends.largest_by_income(t.card, YEAR),
        "T6_weakest_by_margin": lambda t: trends.weakest_by_margin(t.card, YEAR),
        "T7_pay_trend": lambda t: trends.pay_trend(t.card),
        "T8_drugs_cost": lambda t: trends.drugs_cost(t.card),
        "T9_negligence_by_year": lambda t: trends.negligence_by_year(t.card),
        "T10_finance_lines": lambda t: trends.finance_lines(t.card),
        "B1_size_bands": lambda t: peers.size_bands(t.card, YEAR),
        "B2_type_comparison": lambda t: peers.type_comparison(t.card),
        "B3_pay_pressure": lambda t: peers.pay_pressure(t.card, YEAR),
        "B4_regional_health": lambda t: peers.regional_health(t.card, YEAR),
        "B5_cost_per_wte": lambda t: peers.cost_per_wte(t.card),
        "B6_private_income": lambda t: peers.private_income(t.card, YEAR),
        "B7_negligence_by_sector": lambda t: peers.negligence_by_sector(t.card),
        "B8_ebitda_movers": lambda t: peers.ebitda_movers(t.card, YEAR),
        "B9_sickness": lambda t: peers.sickness(
            gold.scorecard(t.fact, t.trusts, t.codes, extra=("avg_days_lost_per_wte",))
        ),
        "B10_academic_income": lambda t: peers.academic_income(t.card, YEAR),
        "E1_dim_trust": lambda t: exports.EXPORTS["dim_trust"].frame(t.warehouse),
        "E2_dim_financial_year": lambda t: exports.EXPORTS["dim_financial_year"].frame(t.warehouse),
        "E3_ie_summary": lambda t: exports.EXPORTS["ie_summary"].frame(t.warehouse),
        "E4_expenditure_breakdown": lambda t: exports.EXPORTS["expenditure_breakdown"].frame(
            t.warehouse
        ),
        "E5_workforce": lambda t: exports.EXPORTS["workforce"].frame(t.warehouse),
        "E6_kpis": lambda t: exports.EXPORTS["kpis"].frame(t.warehouse),
        "E7_income_detail": lambda t: exports.EXPORTS["income_detail"].frame(t.warehouse),
        "E8_expenditure_detail": lambda t: exports.EXPORTS["expenditure_detail"].frame(t.warehouse),
        "E9_profit_and_loss": lambda t: exports.EXPORTS["profit_and_loss"].frame(t.warehouse),
        "E10_balance_sheet": lambda t: exports.EXPORTS["balance_sheet"].frame(t.warehouse),
        "E11_sector_benchmarks": lambda t: exports.EXPORTS["sector_benchmarks"].frame(t.warehouse),
        "X1_enriched_kpis": lambda t: exports.ENRICHED["kpis"].frame(t.warehouse),
        "X2_income_detail_long": lambda t: detail.income_detail(t.fact, t.trusts, t.codes),
        "X3_expenditure_detail_long": lambda t: detail.expenditure_detail(
            t.fact, t.trusts, t.codes
        ),
        "X4_extract_codes": lambda t: dictionary.extract_codes(
            derived.template_grid(t.spark, t.folder)
        ),
        "C1_rows_by_scope": lambda t: checks.rows_by_scope(t.fact),
        "C2_patient_income": lambda t: checks.patient_income(t.fact),
        "C3_income_expenditure_by_year": lambda t: checks.income_expenditure_by_year(t.summary),
        "C4_kpis_by_sector": lambda t: checks.kpis_by_sector(t.kpis, YEAR),
        "C5_deficit_summary": lambda t: checks.deficit_summary(t.summary, YEAR),
        "C6_largest": lambda t: checks.largest(t.kpis, YEAR),
        "C7_largest_deficits": lambda t: checks.largest_deficits(t.kpis, YEAR),
        "C8_cost_mix": lambda t: checks.cost_mix(t.breakdown),
        "C9_workforce_by_year": lambda t: checks.workforce_by_year(t.staff),
        "C10_key_uniqueness": lambda t: checks.key_uniqueness(t.fact),
    }
)


@query("X5_label_rules")
def _(t: Inputs) -> DataFrame:
    label = F.concat(F.lit("  "), "p_name", F.lit(" \t "), "p_type", F.lit(" WTE"))
    return t.table("part").select(
        "p_partkey",
        dictionary.clean_label(label).alias("label"),
        dictionary.clean_worksheet_name(F.concat("p_brand", F.lit(" &amp; x"))).alias("worksheet"),
        dictionary.is_subtotal_label("p_name").alias("name_is_subtotal"),
        dictionary.is_subtotal_label("p_type").alias("type_is_subtotal"),
        dictionary.infer_unit(label).alias("unit"),
        dictionary.infer_unit("p_name").alias("name_unit"),
    )


@query("X6_skipped_worksheets")
def _(t: Inputs) -> DataFrame:
    grid = derived.template_grid(t.spark, t.folder)
    return (
        grid.where(dictionary.keep_worksheet("worksheet_name"))
        .groupBy("worksheet_name")
        .agg(F.count("*").alias("sheet_rows"))
    )


# --- quality --------------------------------------------------------------------------------------


@query("D1_critical_nulls")
def _(t: Inputs) -> DataFrame:
    return quality.batch_problems(t.staged).drop("repeated_rows")


@query("D2_batch_warnings")
def _(t: Inputs) -> DataFrame:
    unmatched = resolve.unmatched_names(t.staged, t.providers).agg(F.count("*").alias("found"))
    repeats = quality.batch_problems(t.staged).select(F.col("repeated_rows").alias("found"))
    return repeats.select(F.lit("repeated_rows").alias("warning"), "found").unionByName(
        unmatched.select(F.lit("unmatched_names").alias("warning"), "found")
    )


def _fact_checks(t: Inputs, prefix: str) -> DataFrame:
    return quality.fact_checks(t.fact, EXPECT).where(F.col("check_name").startswith(prefix))


def _plausibility(t: Inputs, prefix: str) -> DataFrame:
    return quality.plausibility_checks(t.base, EXPECT).where(F.col("check_name").startswith(prefix))


QUERIES.update(
    {
        "D3_row_counts": lambda t: _fact_checks(t, "fact row").unionByName(
            quality.trust_count_check(t.trusts, EXPECT)
        ),
        "D4_year_coverage": lambda t: _fact_checks(t, "year coverage"),
        "D5_blank_org_codes": lambda t: _fact_checks(t, "no null org_codes"),
        "D6_duplicate_keys": lambda t: quality.duplicate_check(t.resolved),
        "D7_orphan_codes": lambda t: quality.orphan_check(t.fact, t.trusts),
        "D8_income_total": lambda t: _plausibility(t, "total income"),
        "D9_deficit_count": lambda t: _plausibility(t, "deficit"),
        "D10_ebitda_mean": lambda t: _plausibility(t, "avg EBITDA"),
        "D11_pay_share": lambda t: _plausibility(t, "avg pay"),
        "D12_balance": lambda t: _plausibility(t, "income - expenditure"),
        "D13_wte_range": lambda t: _plausibility(t, "WTE"),
        "D14_all_checks": lambda t: quality.check_frame(
            quality.all_checks(t.fact, t.trusts, t.base, EXPECT)
        ),
    }
)


@query("D14b_stored_checks")
def _(t: Inputs) -> DataFrame:
    """All checks from stored state: after a load with wrong amounts in one scope, the right file and a refresh."""
    tables = load.Tables(scratch_path(t.spark, "checks"))
    year, kind = RELOAD_SCOPE
    hit = (F.col("financial_year") == year) & (F.col("trust_type") == kind)
    wrong = t.staged.withColumn("total", F.when(hit, -F.col("total") - 7).otherwise(F.col("total")))
    load.take_batch(t.spark, tables, wrong, t.providers)
    stored_checks.refresh(t.spark, tables)
    load.take_batch(t.spark, tables, t.staged.where(hit), None)
    stored_checks.refresh(t.spark, tables)
    return quality.check_frame(stored_checks.checks(t.spark, tables, EXPECT))


# --- measures -----------------------------------------------------------------------------------

KEYS = ["financial_year", "sector"]


def _measure(*names: str, keys: list[str] | None = None) -> Query:
    return lambda t: measures.measure(t.base, names, keys or KEYS, mapped_years=None)


QUERIES.update(
    {
        "G1_income_sums": _measure(
            "total_income_m", "patient_care_income_m", "other_income_m", "total_expenditure_m",
            "operating_surplus_m", "net_surplus_m",
        ),
        "G2_expenditure_sums": _measure(
            "total_pay_m", "total_non_pay_m", "depreciation_amort_m", "drugs_cost_m"
        ),
        "G3_margins": _measure(
            "ebitda_m", "ebitda_margin_pct", "pay_pct_of_income", "net_surplus_margin_pct"
        ),
        "G4_trust_counts": _measure(
            "deficit_trusts", "surplus_trusts", "total_trusts", "deficit_pct", keys=["region"]
        ),
        "G5_staff_cost": _measure("total_wte", "total_staff_cost_m", "avg_cost_per_wte_000s"),
        "G6_wte_groups": _measure(
            "medical_wte", "nursing_wte", "admin_estates_wte", "scientific_tech_wte",
            "medical_pct_of_wte", "nursing_pct_of_wte",
        ),
        "G7_prior_year": _measure("prior_year"),
        "G8_income_growth": _measure("prior_year_income_m", "income_yoy_growth_pct"),
        "G9_margin_changes": _measure(
            "prior_year_ebitda_margin_pct", "ebitda_margin_yoy_pp", "prior_year_pay_pct",
            "pay_pct_yoy_pp",
        ),
        "G10_deficit_change": _measure("prior_year_deficit_trusts", "deficit_trusts_yoy_change"),
        "G11_rag": _measure("ebitda_rag", "surplus_rag", "pay_rag"),
        "G12_rag_colours": _measure("ebitda_rag_colour", "surplus_rag_colour", "pay_rag_colour"),
        "G13_selections": _measure(
            "selected_year", "selected_sector", "selected_region", keys=["region", "financial_year"]
        ),
        "G14_labels": _measure(
            "page_title", "surplus_label", "ebitda_label", "deficit_count_label"
        ),
        "G15_sector_benchmark": _measure(
            "sector_benchmark_ebitda_pct", "ebitda_vs_benchmark_pp", keys=["financial_year"]
        ),
    }
)


@query("G16a_surplus_bridge")
def _(t: Inputs) -> DataFrame:
    return measures.surplus_bridge(t.base)


@query("G16b_best_by_ebitda")
def _(t: Inputs) -> DataFrame:
    rows = t.card.where(F.col("financial_year") == YEAR)
    order = [F.col("ebitda_margin_pct").desc_nulls_last()]
    return ranking.top_ranked(rows, order, "org_code", 20, "rank").select(
        "rank", "org_code", "organisation_name", "sector", "ebitda_margin_pct", "total_income_000s"
    )


@query("G16c_margin_box_plot")
def _(t: Inputs) -> DataFrame:
    margin = "ebitda_margin_pct"
    return t.card.where("sector IS NOT NULL").groupBy(*KEYS).agg(
        F.min(margin).alias("low"),
        *(
            (benchmarks.exact_quantile(margin, share) / 10).alias(name)
            for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ),
        F.max(margin).alias("high"),
    )


@query("G16d_wte_by_sector")
def _(t: Inputs) -> DataFrame:
    return measures.wte_by_sector(t.base)


@query("G16e_deficit_split")
def _(t: Inputs) -> DataFrame:
    return measures.deficit_split(t.base)


# --- plan KPIs ------------------------------------------------------------------------------------


def _shipments(t: Inputs) -> DataFrame:
    """Lines as plan against actual: gross amount is the plan, discounted amount the outcome."""
    cents = F.col("l_extendedprice") * 100
    return t.table("lineitem").select(
        "l_suppkey",
        fiscal.label("l_shipdate").alias("financial_year"),
        fiscal.period("l_shipdate").alias("period"),
        F.when(F.col("l_returnflag") == "A", "EXPENDITURE").otherwise("INCOME").alias("account_type"),
        F.floor(cents + 0.5).alias("plan"),
        F.floor(cents * (1 + F.col("l_tax") - F.col("l_discount")) + 0.5).alias("outcome"),
        F.when(F.col("l_linenumber") == 1, F.floor(cents * F.col("l_tax") + 0.5))
        .otherwise(0)
        .alias("agency"),
        "l_quantity",
    )


@query("K1_savings_achievement")
def _(t: Inputs) -> DataFrame:
    rows = _shipments(t).withColumnsRenamed({"outcome": "delivered_000s", "plan": "target_000s"})
    return plan_kpis.savings_achievement(rows, ["l_suppkey", "financial_year"])


@query("K2_budget_variance")
def _(t: Inputs) -> DataFrame:
    rows = _shipments(t).withColumnsRenamed({"outcome": "actual_000s", "plan": "budget_000s"})
    return plan_kpis.budget_variance(rows, ["l_suppkey", "financial_year", "account_type"])


@query("K3_capital_spend")
def _(t: Inputs) -> DataFrame:
    rows = _shipments(t).withColumnsRenamed({"outcome": "actual_000s", "plan": "plan_000s"})
    rows = rows.withColumn(
        "actual_000s", F.when(F.col("l_quantity") >= 40, 0).otherwise(F.col("actual_000s"))
    )
    return plan_kpis.capital_spend(rows, ["l_suppkey", "financial_year"])


@query("K4_agency_share")
def _(t: Inputs) -> DataFrame:
    rows = _shipments(t).withColumnsRenamed({"agency": "agency_000s", "plan": "pay_000s"})
    return plan_kpis.agency_share(rows, ["l_suppkey", "financial_year"])


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bind(build) for name, build in QUERIES.items()}


__all__ = ["QUERIES", "Inputs", "callables", "VIEW_KEY"]
