"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets its counts in place, with built-in functions only. KLL sketches of four
ratios are built per language and source, and merged to sketches per language and of the whole
corpus. A group's limits are its own, blended with those of its language and these with those
of the corpus, by one formula of their numbers of documents. A ratio fails when it lies far outside its group's quartiles, by a fence
that widens with the group's own spread; the verdicts come from a join on language and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.tables import stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"
LEAST_WORDS, MOST_REPEATED = 50, 50  # of the base rules
PRIOR = 200  # documents that the wider group's limits weigh beside a group's own
FENCE = 3.0  # quartile distances above the upper quartile
#: ratio: (numerator, denominator, least spread): a group whose quartiles meet still has a fence
RATIOS = {
    "symbols": ("n_symbols", "n_words", 0.10),
    "dup_lines": ("n_dup_lines", "n_lines", 0.10),
    "repeats": ("n_repeat_words", "n_words", 0.10),
    "word_length": ("word_chars", "n_words", 2.0),
}


def _words(text: Column) -> Column:
    """Words of a text; a text without any has one empty piece, which is dropped."""
    return F.array_remove(F.split(text, SPACE), "")


def _place_bits(words: Column) -> Column:
    """Mask of the bits that hold a position; the shorter the text, the more for the hash."""
    n = F.size(words)
    return F.when(n < 1 << 16, F.lit((1 << 16) - 1)).when(n < 1 << 20, F.lit((1 << 20) - 1)).otherwise(
        F.lit((1 << 28) - 1)
    ).cast("long")


def _packed(words: Column, mask: Column) -> Column:
    """Every 3-word window as one long: high bits of its hash, then its position; sorted."""
    at = lambda i, k: F.get(words, i + k)
    pack = lambda i: (
        F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))
    )
    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), pack)
    return F.sort_array(F.when(F.size(words) >= 3, windows).otherwise(F.array().cast("array<long>")))


def _repeated(words: Column, packed: Column, mask: Column) -> Column:
    """Sorted positions of the windows that stand twice or more.

    After one sort of longs windows of equal hash are neighbours; those are then compared by
    their words. Where a neighbour of equal hash has other words, the window may have its equal
    further on in the run, and is compared with all of it.
    """
    place = lambda v: v.bitwiseAND(mask).cast("int")

    def close(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseOR(mask) == b.bitwiseOR(mask), F.lit(False))

    def same(a: Column, b: Column) -> Column:
        equal = close(a, b)
        for k in range(3):
            equal = equal & (F.get(words, place(a) + k) == F.get(words, place(b) + k))
        return F.coalesce(equal, F.lit(False))

    def again(v: Column, i: Column) -> Column:
        before, after = F.get(packed, i - 1), F.get(packed, i + 1)
        beyond = F.exists(packed, lambda u: (u != v) & same(v, u))
        run = F.when(close(v, before) | close(v, after), beyond).otherwise(F.lit(False))
        return same(v, before) | same(v, after) | run

    twice = F.filter(packed, again)
    return F.sort_array(F.transform(twice, place))


def _covered(twice: Column) -> Column:
    """Words in the windows at ``twice``: each adds three, less what the next covers again."""
    after = F.slice(F.concat(twice, F.array(F.lit(1 << 30))), 2, F.greatest(F.size(twice), F.lit(1)))
    step = F.zip_with(twice, after, lambda a, b: F.least(b - a, F.lit(3)))
    return F.aggregate(step, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def counted(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, lang, source, ``carried`` columns and counts; one row in place of each.

    Null and empty texts have no words and zero counts. A text's lines are its pieces between
    line feeds, taken as they are. Texts may have up to 2**28 words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        text.alias("_text"),
        *carried,
    )
    rows = rows.select("*", _words(F.col("_text")).alias("_words"), lines.alias("_lines"))
    words, mask = F.col("_words"), F.col("_mask")
    rows = rows.select("*", _place_bits(words).alias("_mask"))
    rows = rows.select("*", _packed(words, mask).alias("_windows"))
    rows = rows.select("*", _repeated(words, F.col("_windows"), mask).alias("_twice"))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        *carried,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_twice")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def _ratio(name: str) -> Column:
    over, under, _ = RATIOS[name]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))


def thresholds(counts: DataFrame) -> DataFrame:
    """lang, source and the greatest accepted value of each ratio, one row per group.

    Sketches are aggregates with map-side partials, so a group of any size costs a task one
    sketch; those of languages and of the corpus are merges of the groups' own.
    """
    own = counts.groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(_ratio(r)).alias(r) for r in RATIOS]
    )
    merged = [F.kll_merge_agg_double(r).alias(f"{r}_2") for r in RATIOS]
    tongues = own.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n_2"), *merged)
    whole = own.agg(*[F.kll_merge_agg_double(r).alias(f"{r}_3") for r in RATIOS])
    joined = own.join(tongues, F.col("lang").eqNullSafe(F.col("_lang"))).join(F.broadcast(whole))  # one row

    def fence(name: str, sketch: str) -> Column:
        low, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(p)) for p in (0.25, 0.75))
        return high + FENCE * F.greatest(high - low, F.lit(RATIOS[name][2]))

    def limit(name: str) -> Column:
        wider = fence(name, f"{name}_3")
        for sketch, n in ((f"{name}_2", "n_2"), (name, "n")):
            wider = (F.col(n) * fence(name, sketch) + PRIOR * wider) / (F.col(n) + PRIOR)
        return wider.alias(f"max_{name}")

    return joined.select("lang", "source", *[limit(r) for r in RATIOS])


def judged(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``counts`` with base_failed and kept, by a join on language and source, null or not."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    within = F.lit(True)
    for name in RATIOS:
        within = within & (_ratio(name) <= F.col(f"max_{name}"))
    out = counts.join(limits, same).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & within).drop("_lang", "_source")


def rated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts, limits and verdict of every row of ``docs`` (doc_id, text, lang, source).

    Null languages and sources are groups like others. Repeated rows each get a verdict.
    The counts are written once, as both the sketches and the verdicts read them. An empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    counts = stored(spark, counted(docs), "quality-counts")
    return judged(counts, thresholds(counts))


def accepted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    Rows are written once with their counts beside them: the sketches read the counts alone,
    and no text is counted twice or moved for its verdict.
    """
    names = {c: f"_row_{i}" for i, c in enumerate(docs.columns)}
    wide = docs.select("doc_id", "lang", "source", "text", *[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    counts = stored(spark, counted(wide, *names.values()), "quality-counts")
    kept = judged(counts, thresholds(counts)).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])
