"""What keeps the tasks of a load small: derived rows dealt by size, bounded files, slim buffers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwide import reference_data as ref
from ledgerwide.operators import merge, resolve
from ledgerwide.plans import gold, load
from ledgerwide.schemas import FACT_SCHEMA, PROVIDER_SCHEMA, STAGED_SCHEMA
from ledgerwide.session import LOAD_BYTES, bounded_tasks
from ledgerwide.sources import derived
from tests.conftest import FOLDER


def staged(rows, *named):
    return rows(STAGED_SCHEMA, *[
        (name, "w", 1, "A02CY01", i, f"c{i}", i, "f", "NHS_TRUST", "2000/01", "CY") for i, name in enumerate(named)
    ])


def test_tasks_that_multiply_the_sums_grow_with_the_suppliers(spark, monkeypatch):
    monkeypatch.setattr(derived, "TASK_ORG_YEARS", 4)
    tasks = -(-derived.table(spark, FOLDER, "supplier").count() * derived.SUPPLIER_YEARS // 4)
    places = derived.raw_rows(spark, FOLDER).select(F.spark_partition_id().alias("p")).distinct().collect()
    assert len(places) > tasks // 8 and max(p[0] for p in places) < tasks


def test_staged_files_are_bounded_in_rows(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "STAGED_FILE_ROWS", 10)
    lists = rows(PROVIDER_SCHEMA, ("Known", "K01", "r", "s", None, "f", "NHS_TRUST", "2000/01"))
    tables = load.Tables(str(tmp_path))
    load.take_batch(spark, tables, staged(rows, *["Known", "Unlisted"] * 35).coalesce(1), lists)
    for path, held in ((tables.staged, 70), (tables.quarantine, 35)):
        files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == held and max(r["count"] for r in files) <= 10
    assert load.fact_table(spark, tables).count() == 35


def test_rows_without_a_provider_stay_where_they_are(spark, rows, monkeypatch):
    batch = staged(rows, "Known", "KNOWN", "Other", None, "Coded")
    lists = rows(PROVIDER_SCHEMA, *[
        (name, code, "r", "s", None, "f", "NHS_TRUST", "2000/01") for name, code in (("known", "K01"), ("Coded", None), (None, "N01"))
    ])
    for names, way in ((400_000, "BroadcastHashJoin"), (1, "ShuffledHashJoin")):
        monkeypatch.setattr(resolve, "BROADCAST_NAMES", names)
        found = resolve.unresolved_rows(batch, lists)
        assert sorted(str(r.organisation_name) for r in found.collect()) == ["Coded", "None", "Other"]
        assert found.columns == batch.columns
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"{way} [coalesce" in plan


def test_first_and_last_rows_of_a_key_carry_their_order_once(spark, rows):
    batch = rows(
        "org_code string, financial_year string, worksheet_name string, table_id smallint, main_code string, "
        "sub_code string, total_000s bigint, trust_type string, source_file string, row_num int",
        ("K", "y", "w2", 2, "m", "s", 5, "t2", "f2", 1), ("K", "y", "w1", 1, "m", "s", 7, "t1", "f1", 9),
        ("K", "y", None, None, "m", "s", None, None, "f2", 3), ("K", "y", "w3", 3, "m", "x", 1, "t", None, None),
    )
    done = merge.settled_batch(batch)
    assert {(r.sub_code, r.worksheet_name, r.table_id, r.trust_type, r.total_000s, r.source_file) for r in done.collect()} == {
        ("s", "w1", 1, "t1", None, "f2"), ("x", "w3", 3, "t", 1, None),
    }
    assert set(done.columns) == {c.strip().split()[0] for c in FACT_SCHEMA.split(",")}
    assert "min_by" not in done._jdf.queryExecution().toString()


BATCH = (
    "org_code string, financial_year string, worksheet_name string, table_id smallint, main_code string, "
    "sub_code string, total_000s bigint, trust_type string, source_file string, row_num int"
)


def test_rows_of_a_batch_are_dealt_by_key_before_they_are_reduced(spark, rows):
    some = [(f"K{i % 7}", "y", "w", 1, "m", f"s{i % 11}", i, "t", f"f{i % 3}", i) for i in range(300)]
    batch = rows(BATCH, *some).repartition(2)
    done = merge.settled_batch(batch, 5)
    assert sorted(map(tuple, done.collect())) == sorted(map(tuple, merge.settled_batch(batch).collect()))
    places = done.select(F.spark_partition_id().alias("p")).distinct().count()
    assert 1 < places <= 5
    plan = done._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Exchange" if "Exchange" in plan else "Repartition") > plan.rindex("Aggregate")


def test_tasks_that_reduce_follow_the_rows(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "TASK_ROWS", 10)
    assert [merge.tasks_for(spark, n) for n in (0, 1, 10_000)] == [1, 1, 1_000]
    dealt = []
    first = merge.settled_batch
    monkeypatch.setattr(merge, "settled_batch", lambda batch, tasks=None: dealt.append(tasks) or first(batch, tasks))
    lists = rows(PROVIDER_SCHEMA, ("Known", "K01", "r", "s", None, "f", "NHS_TRUST", "2000/01"))
    tables = load.Tables(str(tmp_path))
    for _run in range(2):
        load.take_batch(spark, tables, staged(rows, *["Known"] * 200), lists)
    assert dealt == [20, 40]  # the second time the rows that are there count too
    assert load.fact_table(spark, tables).count() == 200


def test_existing_rows_lie_in_a_hash_table(spark, rows):
    old = rows(FACT_SCHEMA, *[(f"K{i}", "y", "w", 1, "m", "s", 1, "t", "f") for i in range(9)])
    settled = merge.settled_batch(rows(BATCH, *[(f"K{i}", "y", "w", 1, "m", "s", i % 2, "t", "f", 1) for i in range(12)]), 3)
    changes = merge.fact_changes(old, settled, [])
    assert sorted(r.org_code for r in changes.collect()) == sorted(["K0", "K2", "K4", "K6", "K8", "K9", "K10", "K11"])
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_task_sizes_are_bounded_while_a_batch_loads(spark, rows, tmp_path, monkeypatch):
    seen = []
    inner = load.quality.assert_loadable
    monkeypatch.setattr(load.quality, "assert_loadable", lambda *a: seen.append({n: spark.conf.get(n) for n in LOAD_BYTES}) or inner(*a))
    before = {n: spark.conf.get(n) for n in LOAD_BYTES}
    lists = rows(PROVIDER_SCHEMA, ("Known", "K01", "r", "s", None, "f", "NHS_TRUST", "2000/01"))
    load.take_batch(spark, load.Tables(str(tmp_path)), staged(rows, "Known"), lists)
    assert seen == [{n: f"{size}b" for n, size in LOAD_BYTES.items()}]
    assert {n: spark.conf.get(n) for n in LOAD_BYTES} == before
    with bounded_tasks(spark, {"spark.sql.files.maxPartitionBytes": 1 << 40}):
        assert {n: spark.conf.get(n) for n in LOAD_BYTES} == before


def test_views_from_one_stored_frame_equal_those_from_the_fact(spark, tmp_path):
    fact, trusts, codes = derived.fact(spark, FOLDER), derived.trusts(spark, FOLDER), ref.code_dimension(spark)
    wide = gold.org_year_wide(fact, trusts, codes)
    wide.write.parquet(str(tmp_path / "wide"))
    found = gold.views_of(spark.read.schema(wide.schema).parquet(str(tmp_path / "wide")), fact, trusts)
    wanted = gold.views(fact, trusts, codes)
    assert list(found) == list(wanted)
    for name, view in wanted.items():
        assert found[name].columns == view.columns and found[name].dtypes == view.dtypes
        assert sorted(map(str, found[name].collect())) == sorted(map(str, view.collect())), name
