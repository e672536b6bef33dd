"""How document filters interact: every order of five filters, and each filter's Shapley value.

Five failure conditions make a five-bit mask per document. The documents that a coalition of
filters removes are those whose mask meets it, so all 32 coalition removals of a language
follow from its counts per mask. What a filter removes at a step of an order is the difference
of two coalition removals. Shapley values come from kernel-weighted least squares under the
efficiency constraint: the normal equations are solved once, in rationals, for all 32 removals
as unknowns, which leaves whole coefficients once they are multiplied by 5!.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.tables import stored
from ledgerwide.llm.words import word_pieces

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
DUPLICATE = 1 << FILTERS.index("E")

LEAST_WORDS = 100  # A: fewer words
LEAST_DISTINCT = 80  # B: percent of words that differ from all earlier ones
MOST_CAPITALS = 10  # C: percent of code points that are A-Z
SIGNS = b"#$%&*|"  # D: any of them

_NO_CAPITALS = bytes(range(65, 91))
_NOT_FIRST = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


def text_mask(text: bytes) -> int:
    """Bits of the conditions A to D for one whole text; its distinct words are all it keeps."""
    words, seen = 0, set()
    for piece in word_pieces(text):
        found = piece.split()
        words += len(found)
        seen.update(found)
    points = len(text) - _count(text, _NOT_FIRST)
    fails = (
        words < LEAST_WORDS,
        100 * len(seen) < LEAST_DISTINCT * words,
        100 * _count(text, _NO_CAPITALS) > MOST_CAPITALS * points,
        _count(text, SIGNS) > 0,
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def rated(docs: DataFrame) -> DataFrame:
    """doc_id, part (language, null as ''), digest of the text, bits of A to D."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2).cast(pa.binary()):
                text = value.as_py() or b""
                masks.append(text_mask(text))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                ["doc_id", "part", "digest", "mask"],
            )

    columns = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")), F.col("text").cast("string")
    )
    return columns.mapInArrow(rate, "doc_id long, part string, digest binary, mask int")


def masked(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, part, mask with the bit of E: some smaller doc_id has the same text.

    Only texts that stand under two ids or more meet the rows again. Both sides of that join
    are read from files, so a text that a third of all rows share is split over tasks.
    """
    slim = stored(spark, rated(docs), "rated")
    least = slim.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = stored(spark, least.where("least < most").select("digest", "least"), "repeated-texts")
    repeated = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    bits = F.col("mask") + F.when(repeated, F.lit(DUPLICATE)).otherwise(0)
    return slim.join(least, "digest", "left").select("doc_id", "part", bits.alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by mask. A doc_id is reduced before it meets labels."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic"),
    )
    held = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    both = held.join(known, "doc_id", "left")
    return both.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def coalition_removals(counts: DataFrame) -> DataFrame:
    """part, total and an array of 32 structs: what each coalition removes."""
    each = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(COALITIONS - 1))).alias("coalition"))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    sums = [F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    tabled = each.groupBy("part", "coalition").agg(F.sum("n").alias("total"), *sums)
    row = F.struct("coalition", "n", "good", "toxic")
    return tabled.groupBy("part").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(row)).alias("v"))


def shapley_coefficients() -> list[list[int]]:
    """For every filter the whole numbers c with 5! times its Shapley value = sum(c[S] * v[S]).

    Minimises the kernel-weighted squares of v(S) - sum of S's values over all coalitions
    but the empty and the whole one, with the values adding up to v(all).
    """
    n, full = len(FILTERS), COALITIONS - 1
    rows = [[Fraction(0)] * (n + 1 + COALITIONS) for _ in range(n + 1)]
    for s in range(1, full):
        size = s.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        members = [i for i in range(n) if s >> i & 1]
        for i in members:
            for j in members:
                rows[i][j] += weight
            rows[i][n + 1 + s] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full] = Fraction(1)
    _solve(rows)
    scaled = [[factorial(n) * x for x in row[n + 1 :]] for row in rows[:n]]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("Shapley coefficients are not whole")
    return [[int(x) for x in row] for row in scaled]


def _solve(rows: list[list[Fraction]]) -> None:
    """Gauss-Jordan elimination in place; the columns beyond the square are right sides."""
    for c in range(len(rows)):
        pivot = next(r for r in range(c, len(rows)) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(len(rows)):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[c])]


def _steps() -> list[str]:
    """Every order and step: order, step, the filter's place, the coalition before it."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append(f"{name},{step},{i},{before}")
            before |= 1 << i
    return steps


def interactions(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per language, order of the five filters and step.

    Null texts and languages count as empty; an empty text fails A alone (and E, if a smaller
    id holds an empty one too). Rows with a null doc_id never fail E and have no label; rows
    with equal ids are no duplicates of each other. Of repeated labels any 1 counts, nulls
    count as 0. Each row counts, repeated ones too. An empty table has no parts and no rows.
    Other columns are not read.
    """
    table = coalition_removals(mask_counts(masked(spark, docs), labels))
    field = F.split("at", ",")
    weights = shapley_coefficients()
    values = [sum((F.lit(c) * F.col("v")[s]["n"] for s, c in enumerate(row) if c), F.lit(0)) for row in weights]
    table = table.withColumn("values", F.array(*values))
    rows = table.select("*", F.explode(F.lit(_steps())).alias("at")).select(
        "part", "total", "v", "values",
        field[0].alias("filter_order"), field[1].cast("int").alias("step"),
        field[2].cast("int").alias("i"), field[3].cast("int").alias("before"),
    )
    own = F.expr("shiftleft(1, i)")

    def removal(coalition: Column, which: str = "n") -> Column:
        return F.element_at("v", coalition + 1)[which]

    after = F.col("before").bitwiseOR(own)
    removed = removal(after) - removal(F.col("before"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - removal(after)).cast("long").alias("kept"),
        removed.cast("long").alias("removed"),
        (removal(own) - removed).cast("long").alias("redundant"),
        (removal(F.lit(COALITIONS - 1)) - removal(F.lit(COALITIONS - 1) - own)).cast("long").alias("unique_fails"),
        (removal(after, "good") - removal(F.col("before"), "good")).cast("long").alias("good_lost"),
        (removal(after, "toxic") - removal(F.col("before"), "toxic")).cast("long").alias("toxic_lost"),
        F.element_at("values", F.col("i") + 1).cast("long").alias("shapley"),
    )
