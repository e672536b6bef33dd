"""How the word use of sources diverges, counted through minimal acyclic transducers.

Terms are runs of ASCII letters and of code points beyond ASCII, with A-Z in lower case. A
language keeps the terms that stand in enough of its documents. The kept terms, sorted, are cut
into blocks of bounded size, and each block becomes the minimal acyclic automaton of its terms,
whose transitions carry the number of smaller terms: walking a term through it gives the term's
ordinal. Whole texts then stream through the transducers, all tokens of a slice side by side,
for the counts per source; the ordinals stand for the terms from there on and break ties.

A vocabulary of any size is handled: the transducers are broadcast in packs of bounded size,
and the texts stream once through every pack.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwide.llm.tables import stored
from ledgerwide.llm.words import PIECE_BYTES, word_pieces

LEAST_DOCUMENTS = 30  # documents of its language that a kept term stands in
PRIOR = 5  # added to every count
SCALE = 1_000_000_000
TOP_TERMS = 50

TERMS_HELD = 400_000  # distinct terms a task holds before it passes their counts on
BLOCK_TERMS = 1 << 16
BLOCK_CELLS = 1 << 21  # of a block's table: states by symbols
PACK_BYTES = 96 << 20  # of the tables of one broadcast
STREAM_BYTES = 1 << 17  # text walked side by side; its arrays then stay in the cache
COUNTS_HELD = 1 << 20  # distinct counts a task holds before it passes them on
PAIR_CELLS = 1 << 16  # sources by terms that one comparison of sources holds

_TERM = np.full(256, 32, np.uint8)
_TERM[65:91] = np.arange(97, 123)
_TERM[97:123] = np.arange(97, 123)
_TERM[128:] = np.arange(128, 256)
_TO_TERMS = _TERM.tobytes()


def term_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The terms of a text in lower case with blanks between, in pieces that divide none."""
    return word_pieces(text.translate(_TO_TERMS), size)


# --- vocabulary -------------------------------------------------------------------------


def document_frequencies(texts: DataFrame) -> DataFrame:
    """lang, term, n: documents that hold the term, summed within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                terms = list(counter)
                for at in range(0, len(terms), 50_000):
                    part = terms[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part)),
                            pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array([counter[t] for t in part], pa.int64()),
                        ],
                        ["lang", "term", "n"],
                    )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                seen: set[bytes] = set()
                for piece in term_pieces(text.as_py()):
                    seen.update(piece.split())
                held.setdefault(lang, Counter()).update(seen)
                if sum(map(len, held.values())) > TERMS_HELD:
                    yield from passed_on()
        yield from passed_on()

    return (
        texts.select("lang", "text")
        .mapInArrow(count, "lang string, term string, n long")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n"))
    )


class Builder:
    """Minimal acyclic automaton of byte strings that come sorted, made term by term.

    The states on the path of the last term stay open; one that no later term can change is
    looked up by its transitions and shared if an equal one exists. State 0 means no state.
    """

    def __init__(self) -> None:
        self.last, self.terms = b"", 0
        self.open: list[list] = [[False, []]]
        self.known: dict[tuple, int] = {}
        self.finals, self.below, self.edges = [False], [0], [()]
        self.symbols: set[int] = set()

    def cells(self) -> int:
        return (len(self.edges) + len(self.open)) * (len(self.symbols) + 1)

    def add(self, term: bytes) -> None:
        shared = 0
        for x, y in zip(term, self.last):
            if x != y:
                break
            shared += 1
        self._close(shared)
        for _ in term[shared:]:
            self.open.append([False, []])
        self.symbols.update(term[shared:])
        self.open[-1][0] = True
        self.last, self.terms = term, self.terms + 1

    def _close(self, depth: int) -> None:
        while len(self.open) - 1 > depth:
            state = self._settled(self.open.pop())
            self.open[-1][1].append((self.last[len(self.open) - 1], state))

    def _settled(self, node: list) -> int:
        key = (node[0], tuple(node[1]))
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.edges)
            self.edges.append(key[1])
            self.finals.append(node[0])
            self.below.append(node[0] + sum(self.below[t] for _, t in key[1]))
        return state

    def packed(self) -> dict[str, bytes | int]:
        """Transitions by state and label with the number of terms before them."""
        self._close(0)
        root = self._settled(self.open[0])
        rows = []
        for state, edges in enumerate(self.edges):
            before = int(self.finals[state])
            for label, target in edges:
                rows.append((state, label, target, before))
                before += self.below[target]
        table = np.array(rows, np.int32).reshape(-1, 4)
        return {
            "root": root,
            "edges": np.ascontiguousarray(table.T).tobytes(),
            "finals": np.array(self.finals, np.uint8).tobytes(),
        }


_BLOCK_SCHEMA = (
    "lang string, part int, block int, local int, term string, n int, cells long, root int, edges binary, finals binary"
)


def built(spark: SparkSession, kept: DataFrame) -> DataFrame:
    """Terms with their place, and after each block of them a row with its transducer."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("lang", pa.string()), ("part", pa.int32()), ("block", pa.int32()), ("local", pa.int32()), ("term", pa.string()),
             ("n", pa.int32()), ("cells", pa.int64()), ("root", pa.int32()), ("edges", pa.binary()), ("finals", pa.binary())]
        )
        lang, part, block, builder = None, None, -1, None

        def closed() -> pa.RecordBatch:
            row = {"lang": lang, "part": part, "block": block, "n": builder.terms, "cells": builder.cells()}
            return pa.RecordBatch.from_pylist([row | builder.packed()], schema)

        for batch in batches:
            rows = []
            for own, term, here in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if builder is None or own != lang or builder.terms >= BLOCK_TERMS or builder.cells() >= BLOCK_CELLS:
                    if builder is not None:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        yield closed()
                        rows = []
                    lang, part, block, builder = own, here, block + 1, Builder()
                rows.append({"lang": own, "part": here, "block": block, "local": builder.terms, "term": term})
                builder.add(term.encode())
            yield pa.RecordBatch.from_pylist(rows, schema)
        if builder is not None:
            yield closed()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept.select("lang", "term").repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    return stored(spark, ranged.withColumn("part", F.spark_partition_id()).mapInArrow(build, _BLOCK_SCHEMA), "vocabulary")


# --- streaming --------------------------------------------------------------------------


@dataclass
class Transducer:
    """A block's automaton as arrays; ordinals count from the language's first term."""

    base: int
    root: int
    symbol: np.ndarray  # 256: column of the table, 0 for labels that the block lacks
    width: int
    finals: np.ndarray
    keys: np.ndarray  # state * width + column of every transition, sorted
    targets: np.ndarray
    weights: np.ndarray
    dense: bool

    @classmethod
    def of(cls, base: int, root: int, edges: bytes, finals: bytes) -> Transducer:
        states, labels, targets, weights = np.frombuffer(edges, np.int32).reshape(4, -1)
        used = np.unique(labels)
        symbol = np.zeros(256, np.int64)
        symbol[used] = np.arange(1, len(used) + 1)
        width, final = len(used) + 1, np.frombuffer(finals, np.uint8).astype(bool)
        keys = states * np.int64(width) + symbol[labels]
        dense = len(final) * width <= 4 * BLOCK_CELLS  # beyond it stands one very long term
        if dense:
            next_state, weight = (np.zeros(len(final) * width, np.int32) for _ in range(2))
            next_state[keys], weight[keys] = targets, weights
            return cls(base, root, symbol, width, final, keys, next_state, weight, True)
        return cls(base, root, symbol, width, final, keys, targets, weights, False)

    def step(self, states: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = states * np.int64(self.width) + self.symbol[labels]
        if self.dense:
            return self.targets[at], self.weights[at]
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        hit = self.keys[place] == at
        return np.where(hit, self.targets[place], 0), np.where(hit, self.weights[place], 0)

    def ordinals(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens that are terms of the block, their ordinals)."""
        token = np.arange(len(begin))
        state, ordinal = np.full(len(begin), self.root), np.full(len(begin), self.base, np.int64)
        found, at = [], begin
        while len(token):
            over = at == end[token]
            if over.any():
                accepted = over & self.finals[state]
                found.append((token[accepted], ordinal[accepted]))
                token, state, ordinal, at = (x[~over] for x in (token, state, ordinal, at))
            state, weight = self.step(state, data[at])
            alive = state > 0
            token, state, ordinal, at = token[alive], state[alive], (ordinal + weight)[alive], at[alive] + 1
        if not found:
            return token, ordinal
        return np.concatenate([t for t, _ in found]), np.concatenate([o for _, o in found])


class _Counts:
    """Counts by (group, ordinal), merged as they come."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def add(self, groups: np.ndarray, ordinals: np.ndarray) -> None:
        self.waiting.append(groups << 40 | ordinals)
        self.size += len(ordinals)

    def merged(self) -> int:
        if self.waiting:
            new, many = np.unique(np.concatenate(self.waiting), return_counts=True)
            keys, back = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, back, np.concatenate([self.counts, many]))
            self.keys, self.counts, self.waiting, self.size = keys, sums, [], 0
        return len(self.keys)

    def passed_on(self) -> Iterator[pa.RecordBatch]:
        self.merged()
        names = list(self.groups)
        langs, sources = (pa.array([n[k] for n in names], pa.string()) for k in (0, 1))
        for at in range(0, len(self.keys), 50_000):
            keys = self.keys[at : at + 50_000]
            group = pa.array(keys >> 40)
            yield pa.RecordBatch.from_arrays(
                [langs.take(group), sources.take(group), pa.array(keys & ((1 << 40) - 1)), pa.array(self.counts[at : at + 50_000])],
                ["lang", "source", "ordinal", "n"],
            )
        self.__init__()


def counted(spark: SparkSession, texts: DataFrame, pack: dict[str, list[tuple]]) -> DataFrame:
    """lang, source, ordinal, n of the terms of one pack of transducers, summed within tasks."""
    shared = spark.sparkContext.broadcast(pack)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {lang: [Transducer.of(*t) for t in blocks] for lang, blocks in shared.value.items()}
        counts = _Counts()
        waiting: dict[str, list[tuple[bytes, int]]] = {}
        sizes: Counter = Counter()

        def walk(lang: str) -> None:
            pieces, groups = zip(*waiting.pop(lang))
            sizes.pop(lang)
            data = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)
            inside = np.zeros(len(data) + 1, bool)
            inside[1:] = data != 32
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            begin, end = edge[::2], edge[1::2]
            first = np.cumsum([0, *(len(p) + 1 for p in pieces)])
            group = np.array(groups, np.int64)[np.searchsorted(first, begin, "right") - 1]
            for transducer in ready[lang]:
                token, ordinal = transducer.ordinals(data, begin, end)
                counts.add(group[token], ordinal)

        for batch in batches:
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()))
            for lang, source, text in zip(*columns):
                if lang not in ready:
                    continue
                for piece in term_pieces(text.as_py(), STREAM_BYTES):
                    waiting.setdefault(lang, []).append((piece, counts.group(lang, source)))
                    sizes[lang] += len(piece)
                    if sizes[lang] >= STREAM_BYTES:
                        walk(lang)
                if counts.size > COUNTS_HELD and counts.merged() > COUNTS_HELD:
                    for own in list(waiting):  # their groups are numbered anew afterwards
                        walk(own)
                    yield from counts.passed_on()
        for own in list(waiting):
            walk(own)
        yield from counts.passed_on()

    return texts.select("lang", "source", "text").mapInArrow(count, "lang string, source string, ordinal long, n long")


def packs(blocks: DataFrame) -> Iterator[dict[str, list[tuple]]]:
    """The transducers in packs whose tables stay within PACK_BYTES, in order of their terms.

    Only the sizes of the blocks (one row for some ten thousand terms) are read at once.
    """
    sizes = blocks.select("part", "block", "cells").orderBy("part", "block").collect()
    groups: list[list] = []
    room = 0
    for row in sizes:
        need = 8 * row.cells
        if not groups or need > room:
            groups.append([])
            room = PACK_BYTES
        groups[-1].append((row.part, row.block))
        room -= need
    place = F.struct("part", "block")
    for group in groups:
        first, last = (F.struct(F.lit(p), F.lit(b)) for p, b in (group[0], group[-1]))
        pack: dict[str, list[tuple]] = {}
        for row in blocks.where((place >= first) & (place <= last)).orderBy("part", "block").collect():
            pack.setdefault(row.lang, []).append((row.base, row.root, bytes(row.edges), bytes(row.finals)))
        yield pack


# --- divergence -------------------------------------------------------------------------


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers."""
    above = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {PRIOR} AS DECIMAL(20, 0))"
    return F.expr(f"1 + ({above}) div CAST({total} + {PRIOR} * terms AS DECIMAL(20, 0))")


def _pair_sums(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value: differences of shares summed over all kept terms, for every two sources.

    Terms are cut into chunks; one comparison holds the sources of a language by the terms of a
    chunk, so its size is bounded by PAIR_CELLS (one term, if there are more sources than that).
    """
    width = F.greatest(F.lit(1), F.expr(f"CAST({PAIR_CELLS} div sources AS BIGINT)"))
    groups = groups.where("terms > 0").withColumn("width", width)
    chunks = groups.select(
        "lang", "sid", "rest", "terms", "width",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(terms - 1) div width"))).alias("chunk"),
    )
    widths = groups.select("lang", "source", F.col("sid").alias("own"), F.col("width").alias("wide"))
    entries = rated.join(widths, ["lang", "source"]).select(
        F.col("lang").alias("own_lang"), F.expr("ordinal div wide").alias("own_chunk"),
        "own", F.expr("ordinal % wide").alias("place"), "p",
    )

    def compare(key: tuple, some: pa.Table, every: pa.Table) -> pa.Table:
        lang, chunk = key[0].as_py(), key[1].as_py()
        if not every.num_rows:
            raise ValueError("counts of a source that is not known")
        wide, terms = every["width"][0].as_py(), every["terms"][0].as_py()
        rest = np.zeros(every.num_rows, np.int64)
        rest[every["sid"].to_numpy()] = every["rest"].to_numpy()
        shares = np.repeat(rest[:, None], min(wide, terms - chunk * wide), axis=1)
        if some.num_rows:
            shares[some["own"].to_numpy(), some["place"].to_numpy()] = some["p"].to_numpy()
        n = len(shares)
        sums = np.concatenate([np.abs(shares - shares[a]).sum(axis=1) for a in range(n)])
        a, b = np.repeat(np.arange(n, dtype=np.int32), n), np.tile(np.arange(n, dtype=np.int32), n)
        apart = a != b
        return pa.table(
            {"lang": pa.array([lang] * int(apart.sum()), pa.string()), "a": a[apart], "b": b[apart], "value": sums[apart]}
        )

    found = entries.groupBy("own_lang", "own_chunk").cogroup(chunks.groupBy("lang", "chunk"))
    found = found.applyInArrow(compare, "lang string, a int, b int, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(spark: SparkSession, docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value, rank: how each source's word use differs from others.

    Null texts, languages and sources count as ''. Every row is a document, repeated ones too.
    A language without kept terms has pairs of value 0 and no terms; a lone source has no pairs.
    Equal values rank by the item's UTF-8 bytes. An empty table gives no rows. Other columns are
    not read.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = document_frequencies(texts).where(F.col("n") >= least_documents)
    vocabulary = built(spark, kept)
    earlier = Window.partitionBy("lang").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = vocabulary.where("n is not null").drop("term", "local")
    blocks = stored(spark, blocks.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "transducers")

    counts = None
    for pack in packs(blocks):
        part = counted(spark, texts, pack).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        part = stored(spark, part, "counts")
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "lang string, source string, ordinal long, n long")

    groups = texts.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = blocks.groupBy("lang").agg(F.sum("n").alias("terms"))
    of_lang = Window.partitionBy("lang")
    groups = (
        groups.join(totals, ["lang", "source"], "left")
        .join(terms, "lang", "left")
        .na.fill(0, ["total", "terms"])
        .withColumn("rest", F.when(F.col("terms") > 0, _share("CAST(0 AS BIGINT)", "total")))
        .withColumn("sid", F.row_number().over(of_lang.orderBy("source")) - 1)
        .withColumn("sources", F.count("*").over(of_lang))
        .withColumn("lang_total", F.sum("total").over(of_lang))
    )
    groups = stored(spark, groups, "groups")
    rated = counts.join(groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    rated = stored(spark, rated.select("lang", "source", "ordinal", "n", _share("n", "total").alias("p")), "shares")
    return _term_rows(rated, groups, vocabulary, blocks).unionByName(_pair_rows(rated, groups))


def _term_rows(rated: DataFrame, groups: DataFrame, vocabulary: DataFrame, blocks: DataFrame) -> DataFrame:
    langs = groups.groupBy("lang").agg(F.max("lang_total").alias("total"), F.max("terms").alias("terms"))
    whole = rated.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(langs, "lang")
    whole = whole.select("lang", "ordinal", _share("n", "total").alias("q"))
    above = rated.join(whole, ["lang", "ordinal"]).where("p > q")
    above = above.select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_TERMS)
    places = blocks.select("lang", "part", "block", "base")
    names = vocabulary.where("term is not null").join(places, ["lang", "part", "block"])
    names = names.select("lang", (F.col("base") + F.col("local")).alias("ordinal"), F.col("term").alias("item"))
    return top.join(names, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pair_rows(rated: DataFrame, groups: DataFrame) -> DataFrame:
    sums = _pair_sums(rated, groups)
    one = groups.select("lang", "source", F.col("sid").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("sid").alias("b"))
    both = one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left").na.fill(0, ["value"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
