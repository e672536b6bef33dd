"""Commits, stored views, quarantine and stamps: all tables change together or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.operators import quality
from ledgerwide.plans import gold, load, stored_checks, stored_views
from ledgerwide.schemas import STAGED_SCHEMA
from ledgerwide.sources import commits, landing, staging
from ledgerwide.streaming.incremental import load_new_files
from tests.test_load import LIST, NEW, OLD, write

SECOND = "TAC_NHS_foundation_trusts_2021-22.csv"
FIRST = "TAC_NHS_trusts_2023-24.csv"


def statement(name, year_code, total, code="SCI0100A", sheet="TAC02 SoCI"):
    return f"{name},{sheet},1,A02{year_code}01,1,{code},{total}"


@pytest.fixture()
def landings(tmp_path):
    (tmp_path / "rows").mkdir()
    (tmp_path / "lists").mkdir()
    rows = [
        write(tmp_path / "rows", FIRST, NEW, statement("Alpha", "CY", 900), statement("Gamma", "CY", 5), statement("Late", "CY", 70)),
        write(tmp_path / "rows", SECOND, NEW, statement("Beta", "CY", 10)),
    ]
    lists = [
        write(tmp_path / "lists", FIRST, LIST, "Alpha,R1H,London,Acute,", "Gamma,R3G,London,Acute,"),
        write(tmp_path / "lists", SECOND, LIST, "Beta,R2B,North,,note"),
    ]
    return tmp_path, rows, lists


def contents(spark, tables):
    """Every table of the warehouse, as rows."""
    readers = (
        load.stamped_fact_table, load.stamped_trust_table, load.worksheet_table, load.code_table, load.year_table, load.quarantine_table,
        lambda s, t: staging.read_table(s, t.staged, STAGED_SCHEMA),
    )
    return [sorted(map(str, read(spark, tables).collect())) for read in readers]


def test_a_load_that_stops_anywhere_leaves_the_former_state(spark, landings, monkeypatch):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"), buckets=4)
    load.load(spark, tables, rows, lists)
    before = contents(spark, tables)
    other = folder / "other"
    other.mkdir()
    fixed = write(other, FIRST, NEW, statement("Alpha", "CY", 950), statement("Newcomer", "CY", 1, sheet="TAC99 New"))
    listed = write(other, "TAC_NHS_trusts_2023-24_list.csv", LIST, "Alpha,R1H,North,Acute,", "Newcomer,R9N,North,Acute,")
    plain_write, plain_commit = commits.Change.write, commits.Change.commit
    stops = 0
    while True:
        left = [stops]

        def stopping(inner, left=left, **kw):
            def run(self, *a, **k):
                if left[0] == 0:
                    raise OSError("stopped")
                left[0] -= 1
                return inner(self, *a, **k)

            return run

        monkeypatch.setattr(commits.Change, "write", stopping(plain_write))
        monkeypatch.setattr(commits.Change, "commit", stopping(plain_commit))
        try:
            load.load(spark, tables, [fixed], [listed])
        except OSError:
            assert contents(spark, tables) == before
            stops += 1
            continue
        break
    assert stops >= 6
    after = contents(spark, tables)
    assert all(x != y for x, y in zip(after[:3], before[:3]))
    got = {(r.org_code, r.financial_year): r.total_000s for r in load.fact_table(spark, tables).collect()}
    assert got == {("R1H", "2023/24"): 950, ("R3G", "2023/24"): 5, ("R9N", "2023/24"): 1, ("R2B", "2021/22"): 10}


def test_of_two_changes_on_one_state_the_second_fails(spark, tmp_path, rows):
    frame = rows("a int, b string", (1, "x"), (2, "y/z"))
    one, two = commits.Change(spark, str(tmp_path)), commits.Change(spark, str(tmp_path))
    one.write(frame, "t", ["b"])
    two.write(frame.limit(1), "t", ["b"])
    one.commit()
    with pytest.raises(Exception, match="exist"):
        two.commit()
    assert sorted(map(tuple, commits.read(spark, str(tmp_path), "t", "a int, b string").collect())) == [(1, "x"), (2, "y/z")]


def test_partitions_are_replaced_kept_and_expired(spark, tmp_path, rows):
    root = str(tmp_path)
    first = commits.Change(spark, root)
    first.write(rows("a int, b string", (1, "x"), (2, "y"), (3, "z")), "t", ["b"])
    first.commit()
    for a in (10, 20):
        change = commits.Change(spark, root)
        assert change.write(rows("a int, b string", (a, "x")), "t", ["b"], ["b=z"]) == {"b=x": change.name}
        change.commit()
        assert commits.read(spark, root, "t", "a int, b string").where("b = 'x'").first()["a"] == a
    assert commits.expire(spark, root) >= 1  # x and z of the first commit
    assert sorted(map(tuple, commits.read(spark, root, "t", "a int, b string").collect())) == [(2, "y"), (20, "x")]
    earlier = commits.read(spark, root, "t", "a int, b string", commits.snapshot(spark, root, 2))
    assert sorted(map(tuple, earlier.collect())) == [(2, "y"), (10, "x")]
    assert not (tmp_path / "t").joinpath(f"version={first.name}", "b=z").exists()
    assert commits.read(spark, root, "none", "a int").isEmpty()


def test_a_reload_without_changes_writes_no_fact_and_keeps_stamps(spark, landings):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"), buckets=4)
    load.load(spark, tables, rows, lists)
    stamps = sorted(map(str, load.stamped_fact_table(spark, tables).collect()))
    trusts = sorted(map(str, load.stamped_trust_table(spark, tables).collect()))
    parts = commits.latest(spark, tables.root).partitions("fact")
    load.load(spark, tables, rows, lists)
    assert commits.latest(spark, tables.root).partitions("fact") == parts
    assert sorted(map(str, load.stamped_fact_table(spark, tables).collect())) == stamps
    assert sorted(map(str, load.stamped_trust_table(spark, tables).collect())) == trusts

    other = folder / "other"
    other.mkdir()
    fixed = write(other, FIRST, NEW, statement("Alpha", "CY", 901), statement("Gamma", "CY", 5))
    load.load(spark, tables, [fixed], [])
    batches = {r.org_code: r.batch_id for r in load.stamped_fact_table(spark, tables).collect()}
    newest = commits.latest(spark, tables.root).notes["batch_id"]
    assert {k for k, b in batches.items() if b == newest} == {"R1H"}
    assert commits.history(spark, tables.root).count() == 3


def test_rows_wait_for_their_provider_list(spark, landings):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"))
    warnings = load.load(spark, tables, rows, [])
    assert warnings["unmatched_names"] == 4 and load.fact_table(spark, tables).isEmpty()
    assert load.quarantine_table(spark, tables).count() == 4
    load.load(spark, tables, [], lists[:1])
    assert {r.org_code for r in load.fact_table(spark, tables).collect()} == {"R1H", "R3G"}
    assert {r.organisation_name for r in load.quarantine_table(spark, tables).collect()} == {"Late", "Beta"}
    other = folder / "other"
    other.mkdir()
    late = write(other, FIRST, LIST, "Alpha,R1H,London,Acute,", "Late,R7L,London,Acute,")
    load.load(spark, tables, [], [late, lists[1]])
    assert {(r.org_code, r.total_000s) for r in load.fact_table(spark, tables).collect()} == {
        ("R1H", 900), ("R3G", 5), ("R7L", 70), ("R2B", 10),
    }
    assert load.quarantine_table(spark, tables).isEmpty()


def test_stream_takes_lists_and_statements_in_any_order(spark, landings):
    folder, rows, lists = landings
    source, listed = folder / "stream", folder / "streamed_lists"
    source.mkdir()
    listed.mkdir()
    tables = load.Tables(str(folder / "w"))

    def run():
        load_new_files(spark, str(source), tables, str(listed), str(folder / "cp"), file_format="csv").awaitTermination()

    for path in rows:
        (source / path.rsplit("/", 1)[1]).write_text(open(path, encoding="utf-8").read(), encoding="utf-8")
    run()
    assert load.fact_table(spark, tables).isEmpty() and load.quarantine_table(spark, tables).count() == 4
    for path in lists:
        (listed / path.rsplit("/", 1)[1]).write_text(open(path, encoding="utf-8").read(), encoding="utf-8")
    run()
    assert {r.org_code for r in load.fact_table(spark, tables).collect()} == {"R1H", "R3G", "R2B"}
    run()
    assert load.quarantine_table(spark, tables).count() == 1


def test_parquet_parts_are_read_by_their_own_footers(spark, rows, tmp_path):
    schema = "OrganisationName string, WorkSheetName string, TableID {}, MainCode string, RowNumber int, SubCode string, Total {}"
    landed = tmp_path / "TAC_NHS_trusts_2023-24.parquet"
    new = rows(schema.format("int", "double"), ("Alpha", "S", 1, "A02CY01", 1, "SCI0100A", 900.9))
    old = rows(schema.format("bigint", "string"), ("Beta", "S", 2, "A02CY01", 1, "SCI0100A", "10.2"))
    old = old.withColumnsRenamed({"OrganisationName": "Organisation Name", "Total": "Value number"})
    for frame in (new, old, new.withColumn("OrganisationName", F.lit("Gamma")).withColumn("Extra", F.lit("x"))):
        frame.coalesce(1).write.mode("append").parquet(str(landed))
    got = landing.read_statement_rows(spark, [str(landed)], "parquet").collect()
    assert sorted((r.organisation_name, r.total, r.table_id, r.source_file) for r in got) == [
        ("Alpha", 900, 1, landed.name), ("Beta", 10, 2, landed.name), ("Gamma", 900, 1, landed.name),
    ]
    new.drop("Total").coalesce(1).write.mode("append").parquet(str(landed))
    with pytest.raises(ValueError, match="part-.*total"):
        landing.read_statement_rows(spark, [str(landed)], "parquet")


def test_compressed_csv_headers(spark, tmp_path):
    import gzip

    path = tmp_path / "TAC_NHS_trusts_2021-22.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(OLD + "\n1,Beta,TAC02 SoCI,A02CY01,1,SCI0100A,10\n")
    assert [(r.organisation_name, r.total) for r in landing.read_statement_rows(spark, [str(path)]).collect()] == [("Beta", 10)]


def views_of(spark, tables):
    return {n: sorted(map(str, stored_views.view_table(spark, tables, n).collect())) for n in VIEWS}


VIEWS = ["income_expenditure", "profit_and_loss", "expenditure_breakdown", "workforce", "balance_sheet", "kpis", "scorecard"]


def rebuilt(spark, tables):
    parts = load.fact_table(spark, tables), load.trust_table(spark, tables), load.code_table(spark, tables)
    return {n: sorted(map(str, f.collect())) for n, f in gold.views(*parts).items()}


def test_stored_views_follow_the_fact_part_by_part(spark, landings):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"), buckets=4)
    assert stored_views.refresh(spark, tables) == set()
    load.load(spark, tables, rows, lists)
    assert len(stored_views.refresh(spark, tables)) == len(commits.latest(spark, tables.root).partitions("fact"))
    assert views_of(spark, tables) == rebuilt(spark, tables) and any(views_of(spark, tables).values())
    assert stored_views.refresh(spark, tables) == set()

    # A corrected amount of one organisation: one part of every view is written again.
    other = folder / "other"
    other.mkdir()
    load.load(spark, tables, [write(other, FIRST, NEW, statement("Alpha", "CY", 1), statement("Gamma", "CY", 5))], [])
    stale = stored_views.refresh(spark, tables)
    assert len(stale) == 1 and stale.pop().startswith("financial_year=2023%2F24/")
    assert views_of(spark, tables) == rebuilt(spark, tables)

    # Another region of one organisation: its bucket in every year.
    load.load(spark, tables, [], [write(other, SECOND, LIST, "Beta,R2B,South,,")])
    assert stored_views.refresh(spark, tables) == {p for p in commits.latest(spark, tables.root).partitions("fact") if p.endswith(bucket(spark, "R2B"))}
    assert views_of(spark, tables) == rebuilt(spark, tables)

    # A new code touches every part.
    grid = rows_of(spark, ("TAC30 Other", 1, ["X", "New line", "ZZZ0001"]))
    load.extend_codes(spark, tables, grid)
    assert load.code_table(spark, tables).where("sub_code = 'ZZZ0001'").count() == 1
    assert load.code_table(spark, tables).count() == ref.code_dimension(spark).count() + 1
    assert stored_views.refresh(spark, tables) == set(commits.latest(spark, tables.root).partitions("fact"))
    assert views_of(spark, tables) == rebuilt(spark, tables)


def test_stored_checks_follow_the_fact_part_by_part(spark, landings):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"), buckets=4)
    expect = quality.Expectations(fact_rows_min=1, trusts_min=1, years=["2022/23", "2023/24", "1990/91"])

    def stored():
        return sorted(map(tuple, quality.check_frame(stored_checks.checks(spark, tables, expect)).collect()))

    def live():
        fact, trusts = load.fact_table(spark, tables), load.trust_table(spark, tables)
        base = gold.measure_base(fact, trusts, load.code_table(spark, tables))
        return sorted(map(tuple, quality.check_frame(quality.all_checks(fact, trusts, base, expect)).collect()))

    assert stored_checks.refresh(spark, tables) == set()
    load.load(spark, tables, rows, lists)
    assert len(stored_checks.refresh(spark, tables)) == len(commits.latest(spark, tables.root).partitions("fact"))
    before = stored()
    assert before == live() and stored_checks.refresh(spark, tables) == set()

    # Views and checks are refreshed apart from each other.
    stored_views.refresh(spark, tables)
    assert stored_checks.refresh(spark, tables) == set() and stored() == before

    # A reload reads the touched part of the fact: all other parts keep the version of their state.
    other = folder / "other"
    other.mkdir()
    load.load(spark, tables, [write(other, FIRST, NEW, statement("Alpha", "CY", 1), statement("Gamma", "CY", 5))], [])
    held = dict(commits.latest(spark, tables.root).partitions("check_state"))
    stale = stored_checks.refresh(spark, tables)
    now = commits.latest(spark, tables.root).partitions("check_state")
    assert len(stale) == 1 and {p for p in now if now[p] != held.get(p)} == stale
    assert stored() == live()


def bucket(spark, org):
    frame = spark.createDataFrame([(org,)], "org_code string")
    return f"org_bucket={frame.select(load.bucket_of(4)).first()[0]}"


def rows_of(spark, *values):
    return spark.createDataFrame(list(values), "worksheet_name string, row_no int, cells array<string>")


def test_years_and_codes_are_stored_and_extended(spark, landings):
    folder, rows, lists = landings
    tables = load.Tables(str(folder / "w"))
    load.load(spark, tables, rows, lists)
    seeded = load.year_table(spark, tables).count()
    other = folder / "other"
    other.mkdir()
    name = "TAC_NHS_trusts_1998-99.csv"
    far = write(other, name, NEW, statement("Alpha", "CY", 3))
    load.load(spark, tables, [far], [])
    assert load.year_table(spark, tables).count() == seeded + 1
    year = load.year_table(spark, tables).where("financial_year = '1998/99'").first()
    assert (str(year.start_date), year.year_label_short) == ("1998-04-01", year.year_label_short)
    assert load.code_table(spark, tables).count() == ref.code_dimension(spark).count()
