"""Landing files to fact: drifted headers, cleaning, reloads, streaming."""

from __future__ import annotations

import pytest

from ledgerwide import reference_data as ref
from ledgerwide.operators import merge, quality, resolve
from ledgerwide.plans import load
from ledgerwide.schemas import PROVIDER_SCHEMA, STAGED_SCHEMA
from ledgerwide.sources import landing, staging
from ledgerwide.streaming.incremental import load_new_files

NEW = "OrganisationName,WorkSheetName,TableID,MainCode,RowNumber,SubCode,Total"
OLD = "TableID,Organisation Name,WorkSheetName,MainCode,RowNumber,SubCode,Value number"
LIST = "Full name of Provider,NHS code,Region,Sector,Comments "


def write(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture()
def files(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    rows = [
        write(
            folder, "TAC_NHS_trusts_2023-24.csv", NEW,
            "Alpha ,TAC02 SoCI,1,A02CY01,1, SCI0100A,900.9",
            "Alpha,TAC02 SoCI,1,A02PY01,1,SCI0100A,800",
            "Alpha,TAC02 SoCI,1,A02CY01,2,SCI0110A,-5.9",
            "Alpha,TAC02 SoCI,1,A02CY01,3,SCI0110A,7",
            ",TAC02 SoCI,1,A02CY01,4,SCI0110A,7",
            "Alpha,TAC02 SoCI,1,A02CY01,5,,7",
            "Alpha,TAC02 SoCI,1,A02CY01,6,SCI0150,",
            "Unlisted,TAC02 SoCI,1,A02CY01,7,SCI0150,1",
            "Alpha,TAC77 New,1,A77CY01,8,NEW0001,n/a",
        ),
        write(
            folder, "TAC_NHS_foundation_trusts_2021-22.csv", OLD,
            "1,Beta,TAC02 SoCI,A02CY01,1,SCI0100A,10",
        ),
    ]
    lists = tmp_path / "lists"
    lists.mkdir()
    providers = [
        write(
            lists, "TAC_NHS_trusts_2023-24.csv", LIST,
            " Alpha , R1H ,London,Acute,", "Alpha,R1H,London,Acute,", "Long,ABCD,London,Acute,x",
        ),
        write(lists, "TAC_NHS_foundation_trusts_2021-22.csv", LIST.rstrip(), "Beta,R2B,North,,note"),
    ]
    write(folder, "TAC_illustrative_2023-24.csv", NEW)
    return str(folder), rows, providers


def fact_rows(spark, tables):
    return sorted(
        (r["org_code"], r["financial_year"], r["main_code"], r["sub_code"], r["total_000s"], r["worksheet_name"])
        for r in load.fact_table(spark, tables).collect()
    )


def test_discovery_skips_the_format_example(spark, files):
    names = [r[0].rsplit("/", 1)[1] for r in landing.discover_files(spark, files[0]).collect()]
    assert names == ["TAC_NHS_foundation_trusts_2021-22.csv", "TAC_NHS_trusts_2023-24.csv"]


def test_staged_rows(spark, files):
    got = sorted(
        (r["organisation_name"], r["sub_code"], r["row_num"], r["total"], r["trust_type"], r["financial_year"])
        for r in landing.read_statement_rows(spark, files[1]).collect()
    )
    assert got == [
        ("Alpha", "NEW0001", 8, 0, "NHS_TRUST", "2023/24"),
        ("Alpha", "SCI0100A", 1, 900, "NHS_TRUST", "2023/24"),
        ("Alpha", "SCI0110A", 2, -5, "NHS_TRUST", "2023/24"),
        ("Alpha", "SCI0110A", 3, 7, "NHS_TRUST", "2023/24"),
        ("Beta", "SCI0100A", 1, 10, "FOUNDATION_TRUST", "2021/22"),
        ("Unlisted", "SCI0150", 7, 1, "NHS_TRUST", "2023/24"),
    ]


def test_parquet_landings_with_both_header_styles(spark, rows, tmp_path):
    new = rows(
        "OrganisationName string, WorkSheetName string, TableID int, MainCode string, RowNumber int, "
        "SubCode string, Total double",
        ("Alpha", "S", 1, "A02CY01", 1, "SCI0100A", 900.9), ("Alpha", "S", 1, "A02CY01", 2, "SCI0110A", None),
    )
    old = new.withColumnsRenamed({"OrganisationName": "Organisation Name", "Total": "Value number"})
    paths = [str(tmp_path / f"TAC_NHS_trusts_{year}.parquet") for year in ("2021-22", "2023-24")]
    for frame, path in zip((old, new), paths):
        frame.write.parquet(path)
    got = landing.read_statement_rows(spark, paths, "parquet").collect()
    assert sorted((r["organisation_name"], r["total"], r["table_id"], r["financial_year"]) for r in got) == [
        ("Alpha", 900, 1, "2021/22"),
        ("Alpha", 900, 1, "2023/24"),
    ]


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path, "TAC_NHS_trusts_2023-24.csv", "OrganisationName,Total", "A,1")
    with pytest.raises(ValueError, match="worksheet_name"):
        landing.read_statement_rows(spark, [path])
    with pytest.raises(ValueError, match="not found"):
        landing.find_name(["Cover", "Notes"], "all data")
    assert landing.find_name(["Cover", "ALL Data"], "All data") == "ALL Data"


def test_load_reload_and_correction(spark, files, tmp_path):
    folder, rows, providers = files
    tables = load.Tables(str(tmp_path / "warehouse"))
    warnings = load.load(spark, tables, rows, providers)
    assert warnings == {"repeated_rows": 1, "unmatched_names": 1}
    first = fact_rows(spark, tables)
    assert first == [
        ("R1H", "2023/24", "A02CY01", "SCI0100A", 900, "TAC02 SoCI"),
        ("R1H", "2023/24", "A02CY01", "SCI0110A", 7, "TAC02 SoCI"),
        ("R1H", "2023/24", "A77CY01", "NEW0001", 0, "TAC77 New"),
        ("R2B", "2021/22", "A02CY01", "SCI0100A", 10, "TAC02 SoCI"),
    ]
    assert load.worksheet_table(spark, tables).where("category = 'OTHER' AND worksheet_name = 'TAC77 New'").count() == 1
    assert load.worksheet_table(spark, tables).count() == len(ref.WORKSHEETS) + 1

    load.load(spark, tables, rows, providers)
    assert fact_rows(spark, tables) == first
    assert load.trust_table(spark, tables).count() == 2

    # A corrected file of one scope: its amounts change, other years stay.
    fixed = write(
        tmp_path, "TAC_NHS_trusts_2023-24.csv", NEW, "Alpha,TAC02 moved,1,A02CY01,1,SCI0100A,950"
    )
    load.load(spark, tables, [fixed], providers[:1])
    after = fact_rows(spark, tables)
    assert ("R1H", "2023/24", "A02CY01", "SCI0100A", 950, "TAC02 SoCI") in after
    assert len(after) == len(first)
    staged = staging.read_table(spark, tables.staged, STAGED_SCHEMA)
    assert staged.where("financial_year = '2023/24'").count() == 1
    assert staged.where("financial_year = '2021/22'").count() == 1


def test_replace_scope_also_empties(spark, tmp_path, rows):
    path = str(tmp_path / "staged")
    two = rows(STAGED_SCHEMA, *(("A", "S", 1, "M", 1, "C", 5, "f", t, "2023/24", "CY") for t in ("NHS_TRUST", "FOUNDATION_TRUST")))
    staging.overwrite_scopes(two, path)
    staging.replace_scope(two.where("false"), path, "2023/24", "NHS_TRUST")
    left = staging.read_table(spark, path, STAGED_SCHEMA).collect()
    assert [(r["trust_type"], r["financial_year"]) for r in left] == [("FOUNDATION_TRUST", "2023/24")]


def test_critical_nulls_stop_a_load(spark, rows):
    bad = rows(STAGED_SCHEMA, ("A", "S", 1, "M", 1, None, 5, "f", "NHS_TRUST", "2023/24", "CY"))
    with pytest.raises(ValueError, match="null_sub_code"):
        quality.assert_loadable(bad, rows(PROVIDER_SCHEMA))


def test_trust_upsert_rules(spark, rows):
    def provider(year, name, sector, region="North"):
        return (name, "R1H", region, sector, None, f"f_{year}", "NHS_TRUST", year)

    first = merge.upsert_trusts(None, rows(PROVIDER_SCHEMA, provider("2021/22", "Alpha", "Acute")))
    later = rows(PROVIDER_SCHEMA, provider("2023/24", "Renamed", None, "South"))
    got = merge.upsert_trusts(first, later).first().asDict()
    assert got == {
        "org_code": "R1H", "organisation_name": "Alpha", "trust_type": "NHS_TRUST", "sector": "Acute",
        "region": "South", "is_foundation": 0, "first_year_seen": "2021/22", "last_year_seen": "2023/24",
    }
    older = rows(PROVIDER_SCHEMA, provider("2020/21", "Older", "Community"))
    assert merge.upsert_trusts(first, older).first()["last_year_seen"] == "2021/22"


def test_a_hot_name_and_a_hot_key_stay_whole(spark):
    """One name holds most rows; one key is repeated thousands of times."""
    staged = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 < 9 THEN 'Hot' ELSE concat('Org', id) END AS organisation_name",
        "'S' AS worksheet_name", "CAST(1 AS SMALLINT) AS table_id",
        "CASE WHEN id % 10 < 5 THEN 'M' ELSE concat('M', id) END AS main_code", "CAST(id AS INT) AS row_num",
        "'C' AS sub_code", "id AS total", "'f' AS source_file", "'NHS_TRUST' AS trust_type",
        "'2023/24' AS financial_year", "'CY' AS year_type",
    )
    providers = staged.selectExpr(
        "organisation_name", "substr(sha2(organisation_name, 256), 1, 8) AS org_code",
        "financial_year", "trust_type",
    ).distinct()
    resolved = resolve.resolve_codes(staged, providers)
    assert resolved.count() == 20_000
    fact = merge.upsert_fact(None, resolved)
    assert fact.count() == 1 + 10_000
    assert fact.where("main_code = 'M'").first()["total_000s"] == 19_994
    assert quality.batch_problems(staged).first()["repeated_rows"] == 9_999


def test_stream_loads_each_file_once(spark, files, tmp_path):
    folder, rows, providers = files
    source = tmp_path / "stream"
    source.mkdir()
    tables = load.Tables(str(tmp_path / "warehouse"))
    listed = landing.read_provider_list(spark, providers)

    def run():
        query = load_new_files(
            spark, str(source), tables, listed, str(tmp_path / "checkpoint"), file_format="csv",
            schema=", ".join(f"`{c}` string" for c in NEW.split(",")),
        )
        query.awaitTermination()
        return query

    write(source, "TAC_NHS_trusts_2023-24.csv", NEW, "Alpha,TAC02 SoCI,1,A02CY01,1,SCI0100A,900")
    run()
    assert len(fact_rows(spark, tables)) == 1
    write(source, "TAC_NHS_foundation_trusts_2021-22.csv", NEW, "Beta,TAC02 SoCI,1,A02CY01,1,SCI0100A,10")
    query = run()
    assert sum(p["numInputRows"] for p in query.recentProgress) <= 2
    assert [r[0] for r in fact_rows(spark, tables)] == ["R1H", "R2B"]


def test_streamed_files_are_mapped_by_their_own_headers(spark, files, tmp_path):
    folder, rows, lists = files
    batch, stream = load.Tables(str(tmp_path / "b")), load.Tables(str(tmp_path / "s"))
    load.load(spark, batch, rows, lists)
    providers = landing.read_provider_list(spark, lists)
    landed = tmp_path / "stream"
    landed.mkdir()
    for path in rows:
        (landed / path.rsplit("/", 1)[1]).write_text(open(path, encoding="utf-8").read(), encoding="utf-8")
    columns = ", ".join(f"`{c}` string" for c in NEW.split(","))
    query = load_new_files(spark, str(landed), stream, providers, str(tmp_path / "cp"), columns, "csv")
    query.awaitTermination()
    names = ["org_code", "financial_year", "sub_code", "total_000s", "worksheet_name"]
    want = sorted(map(tuple, load.fact_table(spark, batch).select(*names).collect()))
    assert sorted(map(tuple, load.fact_table(spark, stream).select(*names).collect())) == want


def test_parts_with_another_header_or_missing_columns_raise(spark, tmp_path):
    parts = tmp_path / "TAC_NHS_trusts_2023-24.csv"
    parts.mkdir()
    write(parts, "part-0.csv", NEW, "Alpha,TAC02 SoCI,1,A02CY01,1,SCI0100A,1")
    write(parts, "part-1.csv", OLD, "1,Beta,TAC02 SoCI,A02CY01,1,SCI0100A,10")
    with pytest.raises(Exception, match="header"):
        landing.read_statement_rows(spark, [str(parts)]).collect()
    bad = write(tmp_path, "TAC_NHS_trusts_2022-23.csv", NEW.replace(",Total", ",Sum"), "a,b,1,c,1,d,1")
    with pytest.raises(ValueError, match="total"):
        landing.read_statement_rows(spark, [bad])


def test_reload_empties_a_scope(spark, files, tmp_path):
    _, rows, lists = files
    tables = load.Tables(str(tmp_path / "w"))
    load.load(spark, tables, rows, lists)
    folder = tmp_path / "again"
    folder.mkdir()
    only_prior = write(folder, "TAC_NHS_trusts_2023-24.csv", NEW, "Alpha,TAC02 SoCI,1,A02PY01,1,SCI0100A,800")
    load.load(spark, tables, [only_prior, rows[1]], lists)
    staged = staging.read_table(spark, tables.staged, STAGED_SCHEMA)
    assert {r.financial_year for r in staged.select("financial_year").distinct().collect()} == {"2021/22"}


def test_dimension_survives_a_stop_between_renames(spark, files, tmp_path):
    _, rows, lists = files
    tables = load.Tables(str(tmp_path / "w"))
    load.load(spark, tables, rows, lists)
    before = sorted(map(tuple, load.trust_table(spark, tables).collect()))
    (tmp_path / "w" / "dim_trust").rename(staging.former(str(tmp_path / "w" / "dim_trust")))
    load.load(spark, tables, rows, lists)
    assert sorted(map(tuple, load.trust_table(spark, tables).collect())) == before


def test_folder_load_finds_parts_below_any_parent(spark, files, tmp_path):
    _, rows, lists = files
    root = tmp_path / "Illustrative_set"
    parts = root / "TAC_NHS_trusts_2023-24.csv"
    parts.mkdir(parents=True)
    (parts / "part-0.csv").write_text(open(rows[0], encoding="utf-8").read(), encoding="utf-8")
    write(root, "TAC_NHS_illustrative_2023-24.csv", NEW)
    tables = load.Tables(str(tmp_path / "w"))
    load.load_folder(spark, tables, str(root), lists[0].rsplit("/", 1)[0])
    assert load.fact_table(spark, tables).count() == 3


def test_ties_in_one_file_do_not_depend_on_arrival(spark, rows):
    schema = (
        "org_code string, financial_year string, main_code string, sub_code string, worksheet_name string, "
        "table_id smallint, trust_type string, total_000s bigint, source_file string, row_num int, organisation_name string"
    )
    tied = [("R1H", "2023/24", "A", "S", "w", 1, "T", n, "f", 5, name) for n, name in ((1, "Beta"), (2, "Alpha"))]
    for order in (tied, tied[::-1]):
        assert [r.total_000s for r in merge.upsert_fact(None, rows(schema, *order)).collect()] == [1]
