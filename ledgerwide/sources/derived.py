"""Statement-shaped tables derived from order lines, for tests and benchmarks.

Suppliers stand in for organisations and ship dates give the financial year.
Amounts are integers from the first step (cents summed as BIGINT), so every
result is exact and independent of partition order. The line table below is the
fixture's only content; its amounts are expressions over these base sums:

n, a, r    amount by return flag N, A, R (null when there is none)
n0, a0, e0 n and a with null as 0; twice r with null as 0
e          twice r (null when there is none)
nf, no, af, ao  n and a split by line status, null as 0
q, qf, qo  quantity, and by line status; c counts lines
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.functions import fiscal, text


def pct(value: str, share: int) -> str:
    """Whole-number share of an amount, in SQL both engines read alike."""
    return f"CAST(floor({value} * {share} / 100) AS BIGINT)"


def _balance_lines() -> list[tuple]:
    bases = ["n0", "a0", "e0", "q"]
    lines = []
    for i, code in enumerate(ref.BALANCE_SHEET_LINES):
        owed = "BAL1260" <= code <= "BAL1390" and code != "BAL1330"
        amount = pct(bases[i % 4], i + 3)
        lines.append((ref.SOFP, 1, "A03CY01", code, f"-({amount})" if owed else amount))
    return lines


# worksheet, table, main code, sub code, amount
LINES: list[tuple[str, int, str, str, str]] = [
    (ref.SOCI, 1, "A02CY01", "SCI0100A", "n"),
    (ref.SOCI, 1, "A02CY01", "SCI0110A", "a"),
    (ref.SOCI, 1, "A02CY01", "SCI0125A", "-e"),
    (ref.SOCI, 1, "A02CY01", "SCI0140A", "n0 + a0 - e0"),
    (ref.SOCI, 1, "A02CY01", "SCI0150", pct("n0", 1)),
    (ref.SOCI, 1, "A02CY01", "SCI0160", f"-({pct('n0', 2)})"),
    (ref.SOCI, 1, "A02CY01", "SCI0170", f"-({pct('n0', 1)})"),
    (ref.SOCI, 1, "A02CY01", "SCI0180", f"-({pct('n0', 2)})"),
    (ref.SOCI, 1, "A02CY01", "SCI0190A", pct("a0", 1)),
    (ref.SOCI, 1, "A02CY01", "SCI0200", pct("q", 50)),
    (ref.SOCI, 1, "A02CY01", "SCI0210", "c"),
    (ref.SOCI, 1, "A02CY01", "SCI0230", f"-({pct('a0', 1)})"),
    (ref.SOCI, 1, "A02CY01", "SCI0240A", f"n0 + a0 - e0 - {pct('n0', 2)}"),
    (ref.SOCI, 1, "A02CY01", "SCI0240B", "CASE WHEN c % 5 = 0 THEN c END"),
    (ref.SOCI, 1, "A02CY01", "SCI0240", f"n0 + a0 - e0 - {pct('n0', 2)}"),
    (ref.SOCI, 1, "A02CY01", "SOC0100", f"-({pct('a0', 3)})"),
    (ref.SOCI, 1, "A02CY01", "SOC0110", pct("a0", 4)),
    (ref.SOCI, 1, "A02CY01", "SOC0140", pct("n0", 3)),
    (ref.SOCI, 1, "A02CY01", "SOC0180", "CASE WHEN c % 2 = 0 THEN q END"),
    (ref.SOCI, 1, "A02CY01", "SOC0190", f"n0 + a0 - e0 - {pct('n0', 2)} + {pct('a0', 1)}"),
    *_balance_lines(),
    (ref.INCOME_1, 1, "A06CY01", "INC0197", pct("nf", 40)),
    (ref.INCOME_1, 1, "A06PY01", "INC0197", pct("nf", 41)),
    (ref.INCOME_1, 1, "A06CY01", "INC0198", pct("nf", 60)),
    (ref.INCOME_1, 1, "A06CY01", "INC0200", pct("no", 20)),
    (ref.INCOME_1, 1, "A06CY01", "INC0210", pct("no", 30)),
    (ref.INCOME_1, 1, "A06CY01", "INC0330", f"CASE WHEN c % 3 <> 0 THEN {pct('no', 5)} END"),
    (ref.INCOME_1, 1, "A06CY01", "INC0340", pct("no", 45)),
    (ref.INCOME_1, 1, "A06CY01", "INC0350", "n"),
    (ref.INCOME_1, 2, "A06CY02", "INC1100", pct("n0", 70)),
    (ref.INCOME_1, 2, "A06CY02", "INC1115", pct("n0", 30)),
    (ref.INCOME_1, 2, "A06CY02", "INC1220", "n"),
    (ref.INCOME_2, 1, "A07CY01", "INC1230A", f"CASE WHEN c % 4 <> 0 THEN {pct('af', 30)} END"),
    (ref.INCOME_2, 1, "A07CY01", "INC1240A", f"CASE WHEN c % 6 <> 0 THEN {pct('ao', 20)} END"),
    (ref.INCOME_2, 1, "A07CY01", "INC1280A", pct("ao", 50)),
    (ref.INCOME_2, 1, "A07CY01", "INC1360", "a"),
    (ref.INCOME_2, 1, "A07CY01", "INC1365", "n0 + a0"),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0100", pct("e", 2)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0110", pct("e", 1)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0130", pct("e", 60)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0140", pct("e", 1)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0150", pct("e", 8)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0160", pct("e", 4)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0170", pct("e", 10)),
    (ref.EXPENDITURE, 2, "A08CY02", "EXP0170", pct("e", 3)),
    (ref.EXPENDITURE, 1, "A08PY01", "EXP0170", pct("e", 9)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0200", pct("e", 2)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0210", pct("e", 1)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0220", pct("e", 1)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0240", pct("e", 4)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0250", pct("e", 2)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0260", f"-({pct('e', 1)})"),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0290A", f"CASE WHEN c % 8 <> 0 THEN {pct('e', 3)} END"),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0300", pct("e", 1)),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0350", f"CASE WHEN c % 7 = 0 THEN {pct('e', 1)} END"),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP0390", "e"),
    (ref.EXPENDITURE, 1, "A08CY01", "EXP9990", pct("e", 5)),
    (ref.STAFF, 1, "A09CY01", "STA0220", pct("e", 61)),
    (ref.STAFF, 1, "A09CY01", "STA0250", pct("e", 60)),
    (ref.STAFF, 1, "A09CY01P", "STA0250", pct("e", 45)),
    (ref.STAFF, 2, "A09CY02", "STA0310", "qf"),
    (ref.STAFF, 2, "A09CY02", "STA0330", pct("q", 15)),
    (ref.STAFF, 2, "A09CY02", "STA0340", pct("q", 10)),
    (ref.STAFF, 2, "A09CY02", "STA0350", "qo"),
    (ref.STAFF, 2, "A09CY02", "STA0370", "CASE WHEN c % 9 <> 0 THEN qf END"),
    (ref.STAFF, 2, "A09CY02", "STA0410", "CASE WHEN c % 13 <> 0 THEN q END"),
    (ref.STAFF, 2, "A09CY02P", "STA0410", pct("q", 80)),
    (ref.STAFF, 3, "A09CY03", "STA0530", "q * 9"),
    (ref.STAFF, 3, "A09CY03", "STA0550", "c"),
    ("TAC99 Unlisted", 1, "A99CY01", "OTH0100", "c"),
]

# Later rows of the same key, and a prior-year row, seen only in raw landings.
RAW_ONLY_LINES = [
    (ref.SOCI, 1, "A02CY01", "SCI0150", f"CASE WHEN c % 4 = 0 THEN {pct('n0', 2)} END"),
    (ref.SOCI, 1, "A02PY01", "SCI0100A", pct("n0", 97)),
]

# The years the derived data covers well; the first and last are partial.
CURRENT_YEAR = "2000/01"
YEARS = ["1998/99", "1999/00", "2000/01"]


# Declared columns of the input tables, so that reading starts no schema job.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def base_sums(spark: SparkSession, folder: str) -> DataFrame:
    """One row per supplier and financial year.

    Grouped on the integer key with map-side combine. A supplier holding a third
    of all lines contributes one partial row per year and map task.
    """
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    units = F.floor(F.col("l_quantity") + 0.5)
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")

    def amount(condition: Column) -> Column:
        return F.floor(F.sum(F.when(condition, cents)) / 100)

    sums = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", fiscal.start_year("l_shipdate").alias("fy"))
        .agg(
            amount(flag == "N").alias("n"),
            amount(flag == "A").alias("a"),
            (amount(flag == "R") * 2).alias("e"),
            F.coalesce(amount((flag == "N") & (state == "F")), F.lit(0)).alias("nf"),
            F.coalesce(amount((flag == "N") & (state == "O")), F.lit(0)).alias("no"),
            F.coalesce(amount((flag == "A") & (state == "F")), F.lit(0)).alias("af"),
            F.coalesce(amount((flag == "A") & (state == "O")), F.lit(0)).alias("ao"),
            F.sum(units).alias("q"),
            F.coalesce(F.sum(F.when(state == "F", units)), F.lit(0)).alias("qf"),
            F.coalesce(F.sum(F.when(state == "O", units)), F.lit(0)).alias("qo"),
            F.count("*").alias("c"),
        )
    )
    return sums.select(
        "*",
        F.coalesce("n", F.lit(0)).alias("n0"),
        F.coalesce("a", F.lit(0)).alias("a0"),
        F.coalesce("e", F.lit(0)).alias("e0"),
    )


def org_code(key: str | Column = "l_suppkey") -> Column:
    return F.format_string("S%06d", text.col(key))


def trust_type(key: str | Column) -> Column:
    return F.when(text.col(key) % 3 == 0, text.NHS_TRUST).otherwise(text.FOUNDATION_TRUST)


def sector(key: str | Column) -> Column:
    """Five sectors, in three spellings; some organisations have none."""
    key = text.col(key)
    choice = F.when(key % 23 == 7, None)
    for i, name in enumerate(["Acute", "Mental Health", "Community", "Ambulance", "Specialist"]):
        spelled = (
            F.when(key % 50 >= 45, name.upper().replace(" ", "_"))
            .when(key % 50 >= 40, name + " Trust")
            .otherwise(name)
        )
        choice = choice.when(key % 5 == i, spelled)
    return choice


def source_file(key: str | Column, start: str | Column) -> Column:
    kind = F.when(trust_type(key) == text.NHS_TRUST, "trusts").otherwise("foundation_trusts")
    start = text.col(start)
    return F.format_string("TAC_NHS_%s_%04d-%02d.csv", kind, start, (start + 1) % 100)


def _exploded(base: DataFrame, keys: list[Column], lines: list[tuple]) -> DataFrame:
    """One row per organisation-year and line.

    Keys are made before the rows are multiplied, so their text is formatted once
    per organisation-year. ``stack`` stays in generated code.
    """
    names = ["worksheet_name", "table_id", "main_code", "row_num", "sub_code", "total_000s"]
    cells = ", ".join(
        f"'{sheet}', {table_id}S, '{main}', {i}, '{sub}', CAST({amount} AS BIGINT)"
        for i, (sheet, table_id, main, sub, amount) in enumerate(lines, start=1)
    )
    keyed = base.select(*keys, "*")
    key_names = keyed.columns[: len(keys)]
    return keyed.selectExpr(
        *(f"`{k}`" for k in key_names), f"stack({len(lines)}, {cells}) AS ({', '.join(names)})"
    )


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """Long fact, unique on organisation, year, main code and sub code."""
    keys = [
        org_code().alias("org_code"),
        fiscal.label_of("fy").alias("financial_year"),
        trust_type("l_suppkey").alias("trust_type"),
        source_file("l_suppkey", "fy").alias("source_file"),
    ]
    return (
        _exploded(base_sums(spark, folder), keys, LINES)
        .where("total_000s IS NOT NULL")
        .select(
            "org_code", "financial_year", "worksheet_name", "table_id", "main_code", "sub_code",
            "total_000s", "trust_type", "source_file",
        )
    )


#: Organisation-years in a task that multiplies them by lines and sorts the rows for a write,
#: and years that a supplier has at most.
TASK_ORG_YEARS, SUPPLIER_YEARS = 8_000, 8


def _dealt(spark: SparkSession, folder: str, base: DataFrame) -> DataFrame:
    """Sums spread over as many tasks as their rows need once they are multiplied.

    The sums are small, so adaptive execution packs them into few tasks, each of which would
    then make, sort and write its share of all rows, whatever their number.
    """
    org_years = table(spark, folder, "supplier").count() * SUPPLIER_YEARS
    bounded = -(-org_years // TASK_ORG_YEARS)
    parallel = min(-(-8 * org_years // TASK_ORG_YEARS), spark.sparkContext.defaultParallelism)
    return base.repartition(max(bounded, parallel, 1), "l_suppkey")


def raw_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Landing-shaped rows: drifted headers, padded text, changing case, prior-year rows,
    repeated keys, nulls."""
    name = F.format_string("Supplier#%09d", "l_suppkey")
    keys = [
        F.concat(F.when(F.col("fy") % 2 == 0, F.upper(name)).otherwise(name), F.lit("  ")).alias(
            "Organisation Name"
        ),
        source_file("l_suppkey", "fy").alias("source_file"),
    ]
    rows = _exploded(_dealt(spark, folder, base_sums(spark, folder)), keys, LINES + RAW_ONLY_LINES)
    return rows.select(
        "Organisation Name",
        F.concat(F.lit(" "), "worksheet_name").alias("WorkSheetName"),
        F.col("table_id").alias("TableID"),
        F.col("main_code").alias("MainCode"),
        F.col("row_num").alias("RowNumber"),
        F.concat("sub_code", F.lit(" ")).alias("SubCode"),
        (F.col("total_000s") + 0.75 * F.signum("total_000s")).cast("string").alias("Value number"),
        "source_file",
    )


def raw_providers(spark: SparkSession, folder: str) -> DataFrame:
    """Provider-list rows per organisation and year; suppliers in debt are not listed,
    and some codes are over-long."""
    base = base_sums(spark, folder).select("l_suppkey", "fy")
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    listed = F.col("s_acctbal") >= 0
    places = table(spark, folder, "supplier").where(listed).join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("l_suppkey")
    return base.join(places, key == F.col("s_suppkey")).select(
        F.concat("s_name", F.lit(" ")).alias("Full name of Provider"),
        F.concat(F.lit(" "), provider_code(key), F.lit(" ")).alias("NHS code"),
        F.col("r_name").alias("Region"),
        F.when((key % 6 == 0) & (F.col("fy") % 4 == 1), None)
        .otherwise(sector(key))
        .alias("Sector"),
        F.when(key % 10 == 0, "merged").alias("Comments "),
        source_file(key, "fy").alias("source_file"),
    )


def provider_code(key: Column) -> Column:
    """Three characters for most, four for a few that the length rule drops."""
    code = F.conv(key.cast("string"), 10, 36)
    code = F.when(F.length(code) >= 3, code).otherwise(F.lpad(code, 3, "0"))
    return F.when(key % 31 == 30, F.concat(F.lit("X"), code)).otherwise(code)


def trusts(spark: SparkSession, folder: str) -> DataFrame:
    """Organisation dimension without suppliers deep in debt, whose facts are orphans."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("s_suppkey")
    return (
        table(spark, folder, "supplier")
        .where("s_acctbal >= -500")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            org_code(key).alias("org_code"),
            F.col("s_name").alias("organisation_name"),
            trust_type(key).alias("trust_type"),
            sector(key).alias("sector"),
            F.when(key % 29 != 3, F.col("r_name")).alias("region"),
            (key % 3 != 0).cast("int").alias("is_foundation"),
        )
    )


def template_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Template sheets made of parts: brands are sheets, codes repeat, layouts vary by row."""
    key, size = F.col("p_partkey"), F.col("p_size")
    sheet = (
        F.when(size % 9 == 0, ref.STAFF)
        .when(size % 9 == 1, "Intro")
        .otherwise(F.concat("p_brand", F.lit(" &amp; more")))
    )
    code = F.concat(
        F.format_string("PRT%04d", key % 700), F.when(key % 3 == 0, "A").otherwise("")
    )
    sign = F.when(key % 3 == 0, "+").when(key % 3 == 1, "-").otherwise("+/-")
    label = (
        F.when(size % 5 == 0, F.concat(F.lit(" total  "), "p_name"))
        .when(size % 5 == 1, F.concat(F.upper("p_type"), F.lit(" 12")))
        .when(size % 5 == 2, F.concat("p_name", F.lit(" wte")))
        .otherwise(F.col("p_name"))
    )
    none = F.lit(None).cast("string")
    cells = (
        F.when(key % 4 == 0, F.array(none, label, sign, code))
        .when(key % 4 == 1, F.array(label, none, F.lit("ABC1234"), code, sign))
        .when(key % 4 == 2, F.array(sign, F.lit("  "), label, code, F.lit("note")))
        .otherwise(F.array(none, none, code))
    )
    return table(spark, folder, "part").select(
        sheet.alias("worksheet_name"), key.alias("row_no"), cells.alias("cells")
    )


def write_landing(spark: SparkSession, folder: str, root: str) -> tuple[list[str], list[str]]:
    """Write both landings as CSV, one folder of parts per source file; returns the folders."""
    names = base_sums(spark, folder).select(source_file("l_suppkey", "fy").alias("n")).distinct()
    # One name per year and type.
    files = sorted(r["n"] for r in names.collect())
    frames = {"rows": raw_rows(spark, folder), "providers": raw_providers(spark, folder)}
    written = []
    for kind, frame in frames.items():
        frame.write.partitionBy("source_file").option("header", True).csv(f"{root}/{kind}")
        written.append([f"{root}/{kind}/source_file={name}" for name in files])
    return written[0], written[1]


STANDARD_NAMES = {"Organisation Name": "OrganisationName", "Value number": "Total"}


def write_mixed_landing(spark: SparkSession, folder: str, root: str) -> dict[str, list[str]]:
    """The statement landing once as CSV and once as Parquet, with headers that change.

    CSV files of odd fiscal years carry the newer names. Parts of every Parquet landing carry
    either names, and the parts with the newer ones other types too.
    """
    rows = raw_rows(spark, folder)
    renamed = rows.withColumnsRenamed(STANDARD_NAMES)
    newer = F.col("source_file").rlike("[13579]-[0-9]{2}[.]")
    typed = renamed.withColumns(
        {"TableID": F.col("TableID").cast("double"), "RowNumber": F.col("RowNumber").cast("bigint"),
         "Total": F.col("Total").cast("decimal(20,2)")}
    )
    odd = F.col("RowNumber") % 2 == 1
    for frame in (rows.where(~newer), renamed.where(newer)):
        frame.write.mode("append").partitionBy("source_file").option("header", True).csv(f"{root}/csv")
    for frame in (rows.where(odd), typed.where(~odd)):
        frame.write.mode("append").partitionBy("source_file").parquet(f"{root}/parquet")
    files = sorted(r[0] for r in rows.select("source_file").distinct().collect())
    return {kind: [f"{root}/{kind}/source_file={name}" for name in files] for kind in ("csv", "parquet")}


def write_provider_landing(spark: SparkSession, folder: str, root: str) -> list[str]:
    """The provider landing as Parquet, one folder of parts per source file that has providers."""
    lists = raw_providers(spark, folder)
    lists.write.partitionBy("source_file").parquet(f"{root}/lists")
    names = sorted(r[0] for r in lists.select("source_file").distinct().collect())
    return [f"{root}/lists/source_file={name}" for name in names]
