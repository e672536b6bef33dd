"""Removal of passages that stand anywhere else, by suffix automata of reference shards.

A window is a run of WINDOW consecutive words. Every window has a seed, the SEED-word run in it
with the least hash (of several the last), which depends on nothing but the window's words. So
equal windows have equal seeds, and a window whose seed stands once in the corpus is unique.
Consecutive windows of one seed make a candidate passage; the passages of a document divide its
windows among themselves.

Passages of seeds that stand more than once are the references. They are made distinct, with
their number, and dealt by seed into shards of bounded size; all windows that can be equal meet
in one shard. A shard's passages build a suffix automaton, and the passages of all documents
stream through it: where the matching statistic reaches the window, the automaton tells how
often that window stands in the corpus. Windows found twice or more are removed.

A seed with very many different contexts would make a shard of any size. Windows of such seeds
are passages of their own, dealt by their words.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.automaton import SuffixAutomaton
from ledgerwide.llm.tables import stored
from ledgerwide.llm.words import Words, run_hashes, signed, split_words, text_slices, word_pieces

WINDOW = 35
SEED = 16
SHARD_BYTES = 600_000  # of passages that build one automaton, about a hundred thousand words
HOT_CONTEXTS = 500  # distinct passages of one seed from which its windows are dealt one by one
FILTER_BITS = 28  # the broadcast filter of repeated seeds has 2 ** 28 bits, whatever their number
HOT_BITS = 24

_PLACE = np.uint64((1 << 28) - 1)


@dataclass
class Passages:
    """Candidate passages of a slice of texts, as positions in its words."""

    row: np.ndarray
    first: np.ndarray  # first window, which starts at its first word
    windows: np.ndarray
    seed: np.ndarray


def passages(words: Words, window: int) -> Passages:
    n = len(words.hashes)
    if n < window:
        none = np.empty(0, np.int64)
        return Passages(none, none, none, none.view(np.uint64))
    size = min(SEED, window)
    grams = run_hashes(words.hashes, np.arange(n - size + 1), size)
    # A smaller low part for later places: of equal hashes the last one is chosen.
    least = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
    wide, span = 1, window - size + 1
    while 2 * wide <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    chosen = (_PLACE - (least & _PLACE)).astype(np.int64)
    start = np.arange(len(chosen))
    # The row of every window's first and last word: windows over a border are none.
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, words.first[1:-1], 1)
    row = np.cumsum(edges)[:n]
    inside = row[: len(chosen)] == row[window - 1 :]
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    begin = np.flatnonzero(new | ~inside)
    end = np.append(begin[1:], len(chosen))
    real = inside[begin]
    begin, end = begin[real], end[real]
    return Passages(row[begin], start[begin], end - begin, grams[chosen[begin]])


def _filters(seeds: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the repeated seeds and of the hot ones among them, by the seeds' low parts.

    They come as words of 64 bits, of which there are at most 2 ** (FILTER_BITS - 6).
    """
    at = F.shiftright(F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6)
    bit = F.expr("shiftleft(1L, CAST((seed & 63) AS INT))")
    hot_bit = F.when(F.col("hot"), bit).otherwise(F.lit(0).cast("long"))
    found = seeds.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("word"), F.bit_or(hot_bit).alias("hot")).toArrow()
    repeated, hot = (np.zeros(1 << (bits - 6), np.uint64) for bits in (FILTER_BITS, HOT_BITS))
    place = found["at"].to_numpy()
    repeated[place] = found["word"].to_numpy().view(np.uint64)
    np.bitwise_or.at(hot, place & (len(hot) - 1), found["hot"].to_numpy().view(np.uint64))
    return repeated, hot


def _held(field: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    low = seeds & np.uint64(64 * len(field) - 1)
    return (field[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def seed_table(texts: DataFrame, window: int) -> DataFrame:
    """seed and hot of the seeds that stand twice or more."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words = split_words(batch.column(0), cased=True)
            found = passages(words, window)
            context = run_hashes(words.hashes, found.first, found.windows + (window - 1)) if len(found.first) else found.seed
            yield pa.RecordBatch.from_arrays([pa.array(signed(found.seed)), pa.array(signed(context))], ["seed", "context"])

    each = texts.select("text").mapInArrow(find, "seed long, context long")
    contexts = each.groupBy("seed", "context").agg(F.count("*").alias("n"))
    seeds = contexts.groupBy("seed").agg(F.sum("n").alias("n"), F.count("*").alias("contexts"))
    return seeds.where("n > 1").select("seed", (F.col("contexts") >= HOT_CONTEXTS).alias("hot"))


class Finder:
    """Candidate passages with a seed that may be repeated, as bytes with one space between words."""

    def __init__(self, repeated: np.ndarray, hot: np.ndarray, window: int) -> None:
        self.repeated, self.hot, self.window = repeated, hot, window

    def rows(self, column: pa.Array) -> Iterator[tuple[int, int, int, bytes]]:
        """(row, place of the first window in its text, route, passage) in order of the rows."""
        words = split_words(column, cased=True)
        found = passages(words, self.window)
        which = np.flatnonzero(_held(self.repeated, found.seed))
        if not len(which):
            return
        raw, more = words.data.tobytes(), self.window - 2
        hot = _held(self.hot, found.seed[which])
        row, first, count = found.row[which], found.first[which], found.windows[which]
        place = first - words.first[row]
        routes = signed(found.seed[which])
        opens, closes = words.begin, words.end
        for r, f, n, p, route, each in zip(
            row.tolist(), first.tolist(), count.tolist(), place.tolist(), routes.tolist(), hot.tolist()
        ):
            cut = raw[opens[f] : closes[f + n + more]].split()
            if each:
                for k in range(n):
                    one = b" ".join(cut[k : k + self.window])
                    yield r, p + k, int.from_bytes(_digest(one)[:8], "little", signed=True), one
            else:
                yield r, p, route, b" ".join(cut)


def reference_passages(texts: DataFrame, finder) -> DataFrame:
    """route, passage, n: distinct candidate passages with the number of places they stand at."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = finder()
        for batch in text_slices(batches):
            held: Counter = Counter((route, passage) for _, _, route, passage in look.rows(batch.column(0)))
            if held:
                routes, found = zip(*held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(routes, pa.int64()), pa.array(found, pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())],
                    ["route", "passage", "n"],
                )

    each = texts.select("text").mapInArrow(find, "route long, passage string, n long")
    return each.groupBy("route", "passage").agg(F.sum("n").alias("n"))


def repeated_windows(references: DataFrame, shards: int, window: int) -> DataFrame:
    """passage (digest) and mask: which of its windows stand twice or more in the corpus."""

    def stream(key: tuple, shard: pa.Table) -> pa.Table:
        routes, weights = shard["route"].to_pylist(), shard["n"].to_pylist()
        total: Counter = Counter()
        for route, n in zip(routes, weights):
            total[route] += n
        ids: dict[bytes, int] = {}
        sequences = []
        for route, passage, n in zip(routes, shard["passage"].cast(pa.binary()).to_pylist(), weights):
            if total[route] > 1:  # else its seed came through the filter by chance
                sequences.append((passage, [ids.setdefault(w, len(ids)) for w in passage.split()], n))
        automaton = SuffixAutomaton(window)
        for _, words, n in sequences:
            automaton.add(words, n)
        automaton.settle()
        digests, masks = [], []
        for passage, words, _ in sequences:
            mask = 0
            for i, (matched, count) in enumerate(automaton.statistics(words)):
                if matched == window and count > 1:
                    mask |= 1 << (i - window + 1)
            if mask:
                digests.append(_digest(passage))
                masks.append(mask)
        return pa.table({"passage": pa.array(digests, pa.binary()), "mask": pa.array(masks, pa.int64())})

    dealt = references.groupBy(F.pmod("route", F.lit(shards)).alias("shard"))
    return dealt.applyInArrow(stream, "passage binary, mask long")


def places(texts: DataFrame, finder) -> DataFrame:
    """text, place, passage: candidate passages of every different text, as digests."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = finder()
        for batch in text_slices(batches):
            column = batch.column(0)
            owners: dict[int, bytes] = {}
            rows, at, found = [], [], []
            for r, place, _, passage in look.rows(column):
                if r not in owners:
                    owners[r] = _digest(column[r].cast(pa.binary()).as_py())
                rows.append(owners[r])
                at.append(place)
                found.append(_digest(passage))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(at, pa.int64()), pa.array(found, pa.binary())],
                ["text", "place", "passage"],
            )

    each = texts.select("text").mapInArrow(find, "text binary, place long, passage binary")
    return each.distinct()


def _told(text: bytes, gone: np.ndarray | None) -> tuple[int, int, str]:
    """Words, removed words and the digest of what is left, with one space between words."""
    left, words, removed, some = hashlib.sha256(), 0, 0, False
    for piece in word_pieces(text):
        found = piece.split()
        kept = found
        if gone is not None:
            here = gone[words : words + len(found)]
            kept = [w for w, g in zip(found, here.tolist()) if not g]
        words += len(found)
        removed += len(found) - len(kept)
        if kept:
            left.update((b" " if some else b"") + b" ".join(kept))
            some = True
    return words, removed, left.hexdigest()


def covered(spans: list[tuple[int, int]], words: int, window: int) -> np.ndarray:
    """Which words the repeated windows cover, from (place, mask) of passages."""
    edge = np.zeros(words + 1, np.int64)
    for place, mask in spans:
        while mask:
            low = (mask & -mask).bit_length() - 1
            edge[place + low] += 1
            edge[place + low + window] -= 1
            mask &= mask - 1
    return np.cumsum(edge[:-1]) > 0


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs`` (doc_id, text).

    Null and blank texts have no words. Repeated rows are copies of each other, so all their
    windows go; equal or null ids do not matter. An empty table gives no rows. Other columns
    are not read. ``window`` may be up to 63 + SEED words.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    repeated, hot = map(spark.sparkContext.broadcast, _filters(seed_table(texts, window)))

    def finder() -> Finder:
        return Finder(repeated.value, hot.value, window)

    references = stored(spark, reference_passages(texts, finder), "passages")
    size = references.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    verdicts = repeated_windows(references, 1 + size // SHARD_BYTES, window)
    found = places(texts, finder).join(verdicts, "passage").groupBy("text")
    spans = found.agg(F.collect_list(F.struct("place", "mask")).alias("spans"))
    spans = stored(spark, spans.select(F.col("text").alias("digest"), "spans"), "spans")
    return _cleaned(texts, finder, spans, window)


def _cleaned(texts: DataFrame, finder, spans: DataFrame, window: int) -> DataFrame:
    """Texts without candidates are done where they are read; the others meet their spans."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = finder()
        for batch in text_slices(batches):
            column = batch.column(1)
            found = passages(split_words(column, cased=True), window)
            open_rows = set(found.row[_held(look.repeated, found.seed)].tolist())
            digests, bodies, done = [], [], []
            for r, value in enumerate(column.cast(pa.binary())):
                text = value.as_py()
                digests.append(_digest(text) if r in open_rows else None)
                bodies.append(text if r in open_rows else None)
                done.append((None, None, None) if r in open_rows else _told(text, None))
            words, removed, left = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary()),
                    pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string()),
                ],
                ["doc_id", "digest", "body", "n_words", "n_removed", "kept_sha256"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = []
            for body, spans_, *done in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5))):
                if body is not None:
                    pairs = [(s["place"], s["mask"]) for s in spans_ or ()]
                    most = max((p + m.bit_length() + window for p, m in pairs), default=0)
                    gone = covered(pairs, max(most, _word_count(body)), window) if pairs else None
                    done = _told(body, gone)
                rows.append(done)
            words, removed, left = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    schema = "doc_id long, digest binary, body binary, n_words long, n_removed long, kept_sha256 string"
    rows = texts.mapInArrow(read, schema).join(spans, "digest", "left")
    rows = rows.select("doc_id", "body", "spans", "n_words", "n_removed", "kept_sha256")
    return rows.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _word_count(text: bytes) -> int:
    return sum(len(piece.split()) for piece in word_pieces(text))
