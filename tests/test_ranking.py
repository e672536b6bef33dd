"""Distributed row numbers, tiles and top rows against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerwide.operators import benchmarks, ranking


def ntile(rows, tiles):
    size, extra = divmod(len(rows), tiles)
    out, at = {}, 0
    for tile in range(1, tiles + 1):
        step = size + (1 if tile <= extra else 0)
        out.update({row: tile for row in rows[at : at + step]})
        at += step
    return out


@pytest.mark.parametrize("sizes", [(1, 2, 3, 5), (400, 7, 1001)])
def test_tiles_with_ties_and_uneven_groups(rows, sizes):
    rng = random.Random(3)
    data = [
        (f"g{g}", rng.choice([1, 1, 1, 2, 50]), f"o{i:05d}")
        for g, size in enumerate(sizes)
        for i in range(size)
    ]
    frame = rows("g string, v bigint, o string", *data)
    got = ranking.tiles(frame, ["g"], [F.col("v"), F.col("o")], 4, "tile").collect()
    want = {}
    for g in {d[0] for d in data}:
        ordered = sorted(d for d in data if d[0] == g)
        want.update(ntile(ordered, 4))
    assert {(r["g"], r["v"], r["o"]): r["tile"] for r in got} == want


def test_numbers_are_consecutive_over_many_partitions(spark):
    frame = spark.range(5_000).selectExpr("id % 2 AS g", "pmod(hash(id), 9) AS v", "id")
    got = ranking.numbered(frame, ["g"], [F.col("v"), F.col("id")], "n", "size").collect()
    for g in (0, 1):
        ordered = sorted((r for r in got if r["g"] == g), key=lambda r: (r["v"], r["id"]))
        assert [r["n"] for r in ordered] == list(range(1, 2_501))
        assert {r["size"] for r in ordered} == {2_500}


def test_null_group_is_kept(rows):
    frame = rows("g string, v bigint", (None, 2), (None, 1), ("a", 5))
    got = ranking.numbered(frame, ["g"], [F.col("v")], "n", "size").collect()
    assert {(r["g"], r["v"]): r["n"] for r in got} == {(None, 1): 1, (None, 2): 2, ("a", 5): 1}


def test_rank_of_top_rows_equals_rank_of_all(rows):
    frame = rows("k string, v bigint", *((f"k{i}", v) for i, v in enumerate([9, 9, 7, 7, 7, 5, None])))
    got = ranking.top_ranked(frame, [F.col("v").desc_nulls_last()], "k", 4, "r").collect()
    assert [(r["k"], r["r"]) for r in got] == [("k0", 1), ("k1", 1), ("k2", 3), ("k3", 3)]


def test_top_rows_need_no_full_sort(spark):
    frame = spark.range(1000).selectExpr("id", "id % 7 AS v")
    plan = ranking.top(frame, [F.col("v")], "id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_exact_median(rows):
    frame = rows("v double", *((v,) for v in (3.4, 3.5, -1.2, 9.9)))
    assert frame.agg(benchmarks.exact_median("v")).first()[0] == 3.5
    assert frame.where("v > 99").agg(benchmarks.exact_median("v")).first()[0] is None


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile_of_any_spread_equals_the_counting_one(spark, share):
    n = F.col("id")
    wide = F.when(n % 3 == 0, F.lit(7.0)).otherwise((F.xxhash64(n) % 10**9) / 10)  # a third share one value
    table = spark.range(60_000).select(
        F.when(n % 5 > 0, F.lit("hot")).otherwise((n % 7).cast("string")).alias("sector"),
        F.when(n % 11 > 0, wide).alias("margin"),
    )
    few = [(None, 1.5), (None, 2.0), ("one", 3.0), ("none", None), ("none", None)]
    table = table.union(spark.createDataFrame(few, table.schema))
    want = table.groupBy("sector").agg(benchmarks.exact_quantile("margin", share).alias("quantile"))
    got = benchmarks.quantile_of_any_spread(table, ["sector"], "margin", share)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert benchmarks.quantile_of_any_spread(table.limit(0), ["sector"], "margin", share).collect() == []
