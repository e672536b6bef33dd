"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are the stated query set and are taken in blocks of bounded size; each block meets
all documents in two passes. Seeds are pairs of neighbouring item words that a document holds
side by side or with one word between. An alignment of m matches, e ignored or changed item
words and i inserted words reaches half of an unchanged copy's score only if 2m - e - i is at
least the item's length L. Of its m - 1 steps from match to match those that are no seed cost
an e or two i, so at least L/3 - 1 steps are seeds, and the alignment spans at most 2L words.
The first pass counts the pairs in the corpus. Half as many places of each item as that bound
allows are left out, the commonest; the rest of the bound must still be met by the others in
2L words, which loses no alignment. The second pass aligns every document window where
it is met with its item, word by word. Items under four words count as exact copies only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.words import Words, ngrams, signed, split_words, text_slices

SEED_WORDS = 2
SHORT = 4  # items with fewer words are found as exact copies only
THRESHOLD = 0.5  # of the score an unchanged copy would have
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_WORDS = 4_000_000  # of items per pass over the corpus: bounds what a task holds
ALONE = np.uint64(0x2545F4914F6CDD1D)  # stands for the second word of an item of one
CELLS = 1 << 20  # words of items and windows aligned at once: bounds what a batch holds


def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of each pair of words, as ``ngrams`` makes it of neighbours."""
    if not len(left):
        return np.empty(0, np.uint64)
    return ngrams(np.stack([left, right], axis=1).reshape(-1), SEED_WORDS)[::2]


def enough(length: int) -> int:
    """Seeds that every alignment of at least half the score holds, for items of ``length``."""
    return max(1, -(-length // 3) - 1)


@dataclass
class Block:
    """Items of one pass: ids, words, where each pair stands, and seeds that a window needs."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray  # item i has words first[i]:first[i + 1]
    grams: np.ndarray  # sorted
    items: np.ndarray
    places: np.ndarray
    need: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> Block:
        found = split_words(pa.array(texts, pa.string()), plain=True)
        grams, items, places = [], [], []
        for i in range(len(ids)):
            row = found.row(i)
            own = pairs(row, np.full(1, ALONE)) if len(row) == 1 else ngrams(row, SEED_WORDS)
            grams.append(own)
            items.append(np.full(len(own), i))
            places.append(np.arange(len(own)))
        flat = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        pick = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64)[order]
        need = np.array([enough(n) for n in np.diff(found.first).tolist()], np.int64)
        return cls(np.array(ids, np.int64), found.hashes, found.first, flat[order], pick(items), pick(places), need)

    def rare(self, grams: np.ndarray, counts: np.ndarray) -> Block:
        """The same items without their commonest places, half as many as the bound allows.

        ``counts`` tells how often the corpus holds each of ``grams``; others it does not hold.
        """
        sort = np.argsort(grams)
        grams, counts = np.append(grams[sort], np.uint64(0)), np.append(counts[sort], 0)
        at = np.searchsorted(grams[:-1], self.grams)
        seen = np.where(grams[at] == self.grams, counts[at], 0)
        order = np.lexsort((-seen, self.items))
        start = np.searchsorted(self.items[order], np.arange(len(self.ids)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - start[self.items[order]]
        keep = rank >= (self.need // 2)[self.items]
        return Block(
            self.ids, self.words, self.first, self.grams[keep], self.items[keep], self.places[keep], self.need - self.need // 2
        )

    def item(self, i: int) -> np.ndarray:
        return self.words[self.first[i] : self.first[i + 1]]


class Seeds:
    """Finds a block's pairs among words: a bitmap of 2**20 bits, then binary search."""

    def __init__(self, grams: np.ndarray, alone: bool) -> None:
        """``grams``: sorted; ``alone``: whether some stand for items of one word."""
        self.grams, self.alone = grams, alone
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    @classmethod
    def of(cls, block: Block) -> Seeds:
        return cls(block.grams, bool((np.diff(block.first) == 1).any()))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words where a seed begins, and the first equal seed's position."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(self.grams):
            h = words.hashes
            found += [self._found(words, pairs(h[:-k], h[k:]), k + 1) for k in (1, 2)]
            if self.alone:
                found.append(self._found(words, pairs(h, np.full(len(h), ALONE)), 1))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _found(self, words: Words, own: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.bitmap[(own >> np.uint64(44)).astype(np.int64)])
        row = np.searchsorted(words.first, at, "right")
        at = at[words.first[row] >= at + wide]
        seed = np.searchsorted(self.grams, own[at])
        same = self.grams[np.minimum(seed, len(self.grams) - 1)] == own[at]
        return at[same], seed[same]


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its window, all columns of a row at once."""
    n, tall, wide = len(items), max(map(len, items)), max(map(len, windows))
    left, right = np.zeros((n, tall), np.uint64), np.zeros((n, wide), np.uint64)
    inside_l, inside_r = np.zeros((n, tall), bool), np.zeros((n, wide), bool)
    for k, (a, b) in enumerate(zip(items, windows)):
        left[k, : len(a)], inside_l[k, : len(a)] = a, True
        right[k, : len(b)], inside_r[k, : len(b)] = b, True
    slope = -GAP * np.arange(1, wide + 1, dtype=np.int32)
    above = np.zeros((n, wide + 1), np.int32)
    best = np.zeros(n, np.int32)
    for i in range(tall):
        equal = (left[:, i : i + 1] == right) & inside_r & inside_l[:, i : i + 1]
        here = above[:, :-1] + np.where(equal, MATCH, MISMATCH).astype(np.int32)
        np.maximum(here, above[:, 1:] + GAP, out=here)
        np.maximum(here, 0, out=here)
        # A gap along the row costs the same each step, so the best start is a running maximum.
        here = np.maximum.accumulate(here + slope, axis=1) - slope
        above[:, 1:] = here
        np.maximum(best, here.max(axis=1), out=best)
    return best


def scores(block: Block, seeds: Seeds, texts: pa.Array, threshold: float) -> list[tuple[int, int, float]]:
    """(row, item position, score) of every text and item at or over the threshold."""
    words = split_words(texts, plain=True)
    at, seed = seeds.hits(words)
    if not len(at):
        return []
    count = np.searchsorted(seeds.grams, seeds.grams[seed], "right") - seed
    which = np.repeat(seed, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(at, count)
    item = block.items[which]
    row = np.searchsorted(words.first, at, "right") - 1
    length = block.first[item + 1] - block.first[item]
    # A window begins at a seed that has as many others behind it as needed.
    order = np.lexsort((at, item, row))
    at, which, item, row, length = at[order], which[order], item[order], row[order], length[order]
    group = np.cumsum(np.concatenate([[0], (np.diff(row) != 0) | (np.diff(item) != 0)]))
    key = group * (4 * len(words.hashes) + 4) + at
    reach = np.minimum(2 * length, 2 * len(words.hashes))
    dense = np.searchsorted(key, key + reach, "right") - np.arange(len(key)) >= block.need[item]
    at, which, item, row, length = at[dense], which[dense], item[dense], row[dense], length[dense]
    begin = np.maximum(at - block.places[which] - length, words.first[row])
    end = np.minimum(at - block.places[which] + 2 * length + 2, words.first[row + 1])
    order = np.lexsort((begin, item, row))
    windows: list[list[int]] = []
    for r, i, b, e in zip(*(x[order].tolist() for x in (row, item, begin, end))):
        last = windows[-1] if windows else None
        if last and last[0] == r and last[1] == i and b <= last[3]:
            last[3] = max(last[3], e)
        else:
            windows.append([r, i, b, e])
    windows.sort(key=lambda w: w[3] - w[2])
    best: dict[tuple[int, int], float] = {}
    for part in _batches(windows, np.diff(block.first)):
        got = align([block.item(w[1]) for w in part], [words.hashes[w[2] : w[3]] for w in part])
        for (r, i, _, _), score in zip(part, got.tolist()):
            length = int(block.first[i + 1] - block.first[i])
            share = score / (MATCH * length)
            if share >= (threshold if length >= SHORT else 1.0):
                best[r, i] = max(share, best.get((r, i), 0.0))
    return [(r, i, s) for (r, i), s in sorted(best.items())]


def _batches(windows: list[list[int]], lengths: np.ndarray) -> Iterator[list[list[int]]]:
    """Windows in their order, as many at once as keep the padded arrays within ``CELLS``."""
    part: list[list[int]] = []
    tall = wide = 0
    for window in windows:
        tall, wide = max(tall, int(lengths[window[1]])), max(wide, window[3] - window[2])
        if part and (len(part) + 1) * (tall + wide) > CELLS:
            yield part
            part, tall, wide = [], int(lengths[window[1]]), window[3] - window[2]
        part.append(window)
    if part:
        yield part


def blocks_of(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float) -> Iterator[Block]:
    """Blocks of items with their rare seeds, counted over all of ``docs``."""
    if threshold < THRESHOLD:
        raise ValueError(f"seeds are only sure to be met from {THRESHOLD}, not at {threshold}")
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna().distinct()
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0
    parts = max(1, -(-total // BLOCK_WORDS))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        rows.sort()
        block = Block.of([r[0] for r in rows], [r[1] for r in rows])
        alone = bool((np.diff(block.first) == 1).any())
        state = spark.sparkContext.broadcast([np.unique(block.grams), alone])

        def count(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(*state.value)
            seen = np.zeros(len(seeds.grams), np.int64)
            for batch in text_slices(batches):
                found = seeds.hits(split_words(batch.column(0), plain=True))[1]
                seen += np.bincount(found, minlength=len(seen))
            some = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(seeds.grams[some])), pa.array(seen[some])], ["gram", "seen"]
            )

        counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "gram long, seen long")
        # Two longs for each pair of words of the block, BLOCK_WORDS at most.
        seen = counted.groupBy("gram").agg(F.sum("seen").alias("seen")).toArrow()
        yield block.rare(seen["gram"].to_numpy().view(np.uint64), seen["seen"].to_numpy())


def _shared(spark: SparkSession, block: Block):
    fields = [block.ids, block.words, block.first, block.grams, block.items, block.places, block.need]
    return spark.sparkContext.broadcast(fields)


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, item_id, score for every document and item whose alignment reaches ``threshold``.

    score is the best local alignment's share of the item's own. Null and empty texts, null
    item ids give no rows, items under four words only exact copies; repeated documents each give
    theirs; a repeated item counts once. Thresholds under 0.5 are refused. Words ignore case (A-Z) and ASCII punctuation. Empty tables
    give no rows. Other columns of both tables are not read.
    """
    schema = "doc_id long, item_id long, score double"
    found: DataFrame | None = None
    for block in blocks_of(spark, docs, benchmark, threshold):
        state = _shared(spark, block)

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            mine = Block(*state.value)
            seeds = Seeds.of(mine)
            for batch in text_slices(batches):
                rows = scores(mine, seeds, batch.column(1), threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r for r, _, _ in rows], pa.int64())),
                        pa.array([int(mine.ids[i]) for _, i, _ in rows], pa.int64()),
                        pa.array([s for _, _, s in rows], pa.float64()),
                    ],
                    ["doc_id", "item_id", "score"],
                )

        texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Rows of ``docs``, all columns, that no item's alignment reaches; rows never move."""
    at = docs.columns.index("text")
    for block in blocks_of(spark, docs, benchmark, threshold):
        state = _shared(spark, block)

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            mine = Block(*state.value)
            seeds = Seeds.of(mine)
            for batch in text_slices(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, _, _ in scores(mine, seeds, batch.column(at), threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
