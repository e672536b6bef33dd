"""MinHash near-duplicates by a multi-index Hamming join.

Every text's shingle set gets ``5 * m`` MinHash values, cut to 12 bits; five of them make one
60-bit chunk. Two signatures that differ in at most ``2 * m - 1`` places have, by pigeonhole,
a chunk with at most one difference, so both have the same key when that place is blanked:
all five blankings of every chunk are enumerated as keys, and equal keys find every pair
within the distance. ``layout`` picks m so that a pair at the similarity threshold exceeds
the distance with a probability below ``miss``; pairs above it do so far more rarely.

Texts with equal shingle sets are one class before any of this, so copies never meet as
pairs. Inside a bucket no all-pairs list is made either. A first round pairs each member with
one hub of its bucket, that which meets the most others; later ones only members outside their bucket's largest component,
each with one member of that. Members already in one component need no further test. What
pairs of different components are left is searched last. Where a main component's buckets hold
few other members, pairs are listed: a pair comes out of the join once, in the first bucket it
shares, and only if its signatures are within the distance and two longer signatures of the few
texts concerned still allow the similarity, so no link is lost and no pair is repeated. One of
them keeps the parity of the shingles that fall on each of its bits: two sets differ in at least
as many shingles as their parities differ in bits; the other holds more MinHash values.

Where they hold many, as around a text with many near copies that are not linked, a list would
grow with the square of their number. There each set is taken as its difference from one center's
set. With |A| and |B| given, two sets are linked if and only if their differences share a known
number of shingles, so in any order of the shingles the first shared one stands early in both.
Those of few members come first, and an equal one among the early ones is what a candidate pair
takes. Any order gives all links; which ones are of few members is judged by a quarter of them. If a pair needs to share none, both members are
linked with the one that is nearest, which stands for them.
Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwide.llm.bits import field_of, held, opened, packed
from ledgerwide.llm.components import connected_components
from ledgerwide.llm.tables import discard, stored
from ledgerwide.llm.words import mix, shingle_set, split_words, text_slices

PLACES = 5  # values in a chunk
BITS = 12  # bits kept of a value
MISS = 1e-5  # accepted chance that a pair at the threshold exceeds the distance
HUB_ROUNDS = 2  # at most; fewer when nothing is left or a round finds nothing
OFTEN = (1, 4, 16, 64)  # members of a quarter of a group that make a shingle frequent, more and more so
LISTED = 32  # pairs that are listed for a member of a main component's buckets, on average

FILTER_BITS = 27  # of the bit fields that spare shuffles
FINE = 1024  # values of the longer signature, of 4 bits each
PARITY = 2048  # bits of the parity signature
BLOCK = 2048  # nodes of a block: two blocks' longer signatures lie in a task

_PLACE = (1 << BITS) - 1
_LOW = sum(1 << (BITS * k) for k in range(PLACES))


def layout(similarity: float, miss: float = MISS) -> int:
    """Chunks needed so that pairs at ``similarity`` stay within 2 * chunks - 1 differences."""
    p = 1.0 - similarity
    for chunks in range(4, 61):
        n = PLACES * chunks
        over = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(2 * chunks, n + 1))
        if over <= miss:
            return chunks
    raise ValueError(f"similarity {similarity} is too low for this index")


def fine_limit(similarity: float, miss: float = MISS) -> int:
    """Places of the longer signature that a pair at ``similarity`` may differ in."""
    q = (1.0 - similarity) * 15 / 16  # unequal values still share 4 bits by chance
    over = 1.0
    for allowed in range(FINE):
        over -= comb(FINE, allowed) * q**allowed * (1 - q) ** (FINE - allowed)
        if over <= miss:
            return allowed
    return FINE


def chunk_columns(chunks: int) -> list[str]:
    return [f"s{c}" for c in range(chunks)]


def _least(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """MinHash values of a set under every factor and shift."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 1024):
        part = (values[None, at : at + 1024] ^ shifts[:, None]) * factors[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return mix(least)


def _packed(values: np.ndarray, bits: int, each: int) -> np.ndarray:
    """The top bits of ``each`` values to a long."""
    short = values >> np.uint64(64 - bits)
    weights = np.uint64(1) << (np.arange(each, dtype=np.uint64) * np.uint64(bits))
    return (short.reshape(-1, each) * weights).sum(axis=1, dtype=np.uint64).view(np.int64)


def _hashes(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    factors = random.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
    return factors, random.integers(0, 2**64, n, dtype=np.uint64)


def signatures(docs: DataFrame, shingle: int, chunks: int) -> DataFrame:
    """doc_id, cls (hash of the shingle set, null for a text without words), n_shingles, s0.."""
    names = chunk_columns(chunks)
    places = PLACES * chunks

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(places, 10)
        for batch in text_slices(batches):
            words = split_words(batch.column(1))
            rows = batch.num_rows
            cls, sizes = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            signs = np.zeros((rows, chunks), np.int64)
            for r in range(rows):
                values = shingle_set(words.row(r), shingle)
                sizes[r] = len(values)
                if len(values):
                    cls[r] = set_hash(values)
                    signs[r] = _packed(_least(values, *hashes), BITS, PLACES)
            empty = sizes == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, mask=empty), pa.array(sizes)]
                + [pa.array(signs[:, c]) for c in range(chunks)],
                ["doc_id", "cls", "n_shingles", *names],
            )

    schema = "doc_id long, cls long, n_shingles long, " + ", ".join(f"{n} long" for n in names)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, schema)


def set_hash(values: np.ndarray) -> int:
    """64-bit hash of a sorted shingle set."""
    spread = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    total = np.uint64(int(spread.sum(dtype=np.uint64)))
    both = np.array([total, np.bitwise_xor.reduce(mix(values)), len(values)], np.uint64)
    return int(mix(mix(both[:1]) + both[1:2] + both[2:] * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)[0])


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """For each row every chunk with each place blanked in turn, hashed with its position."""
    columns = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in range(1, batch.num_columns)]
    keys = np.empty((batch.num_rows, PLACES * len(columns)), np.uint64)
    for c, column in enumerate(columns):
        for place in range(PLACES):
            blank = np.uint64(~(_PLACE << (BITS * place)) & (2**64 - 1))
            at = c * PLACES + place
            keys[:, at] = mix(mix(column & blank) + np.uint64((at + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    return keys


def fine_columns() -> list[str]:
    return [f"f{k}" for k in range(FINE // 16)]


def parity_columns() -> list[str]:
    return [f"e{k}" for k in range(PARITY // 64)]


def parity(values: np.ndarray) -> np.ndarray:
    """Whether an odd number of a set's values falls on each of the bits, as longs."""
    places = (mix(values ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(PARITY)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=PARITY) & 1).astype(np.uint8)).view(np.int64)


def fine_signatures(texts: DataFrame, shingle: int) -> DataFrame:
    """node and its longer signatures, from (node, text)."""
    names = fine_columns() + parity_columns()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(FINE, 11)
        for batch in text_slices(batches):
            words = split_words(batch.column(1))
            signs = np.zeros((batch.num_rows, len(names)), np.int64)
            for r in range(batch.num_rows):
                values = shingle_set(words.row(r), shingle)
                signs[r] = np.concatenate([_packed(_least(values, *hashes), 4, 16), parity(values)])
            columns = [pa.array(signs[:, c]) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["node", *names])

    return texts.select("node", "text").mapInArrow(sign, "node long, " + ", ".join(f"{n} long" for n in names))


def _allowed(similarity: float, nodes: np.ndarray, sizes: np.ndarray, signs: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Which pairs of nodes have longer signatures that allow the similarity; ``nodes`` are sorted.

    The parity test never refuses a pair that has it: sets of T values together that differ in
    d have a similarity of (T - d) / (T + d).
    """
    percent, places, limit = round(100 * similarity), FINE // 16, fine_limit(similarity)
    low = np.uint64(int("1" * 16, 16))
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 4096):
        p, q = np.searchsorted(nodes, a[at : at + 4096]), np.searchsorted(nodes, b[at : at + 4096])
        odd = np.bitwise_count(signs[p, places:] ^ signs[q, places:]).sum(axis=1, dtype=np.int64)
        left = np.flatnonzero(odd * (100 + percent) <= (100 - percent) * (sizes[p] + sizes[q]))
        x = signs[p[left], :places] ^ signs[q[left], :places]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        keep[at + left] = np.bitwise_count(x & low).sum(axis=1, dtype=np.int64) <= limit
    return keep


def _fine_pairs(pairs: DataFrame, signs: DataFrame, blocks: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose longer signatures allow the similarity.

    Nodes are dealt to blocks by their hash and pairs lie in cells of two blocks, so a
    signature moves once for each cell in which its node has a pair, not for each pair.
    """
    names = fine_columns() + parity_columns()
    cell = [F.pmod(c, F.lit(blocks)).alias(n) for c, n in (("a", "left"), ("b", "right"))]
    dealt = pairs.select(*cell, "a", "b")
    needed = dealt.select("left", "right", F.explode(F.array("a", "b")).alias("node")).distinct()
    beside = needed.join(signs.select("node", "n_shingles", *names), "node")
    beside = beside.select(F.col("left").alias("l"), F.col("right").alias("r"), "node", "n_shingles", *names)

    def test(some: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("node")
        columns = [known[c].to_numpy().view(np.uint64) for c in names]
        a, b = some["a"].to_numpy(), some["b"].to_numpy()
        signed = np.stack(columns, axis=1)
        keep = _allowed(similarity, known["node"].to_numpy(), known["n_shingles"].to_numpy(), signed, a, b)
        return some.select(["a", "b"]).filter(pa.array(keep))

    cells = dealt.groupBy("left", "right").cogroup(beside.groupBy("l", "r"))
    return cells.applyInArrow(test, "a long, b long")


def differences(left: str, right: str) -> Column:
    """Places in which two chunks differ: every 12 bits are folded onto their lowest."""
    x = F.col(left).bitwiseXOR(F.col(right))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 6))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 3))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(x.bitwiseAND(F.lit(_LOW)))


def _near(columns: list[str], similarity: float, sizes: tuple[str, str]) -> Column:
    """Within the signature distance, and of sizes that allow the similarity."""
    apart = [differences(f"p_{c}", f"q_{c}") for c in columns]
    percent = round(100 * similarity)
    fits = 100 * F.least(*sizes) >= percent * F.greatest(*sizes)
    return fits & (sum(apart[1:], apart[0]) <= 2 * len(columns) - 1)


def _first_shared(columns: list[str]) -> Column:
    """Whether a row's key (at) is the first of those that its two signatures share."""
    chunk, place = F.floor(F.col("at") / PLACES), F.col("at") % PLACES
    first, apart = F, F
    for c, name in enumerate(columns):
        here = differences(f"p_{name}", f"q_{name}")
        first = first.when(here <= 1, F.lit(c))
        apart = apart.when(chunk == c, here)
    return (first == chunk) & ((apart == 1) | (place == 0))


def _buckets(spark: SparkSession, classes: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, at, node) of the keys that two or more nodes share; at: the key's position.

    First only keys are counted. Those counted twice or more fill a bit field, and the nodes'
    keys are made anew and pass through it, so a key of one node seldom moves again; one that
    does is a bucket of one node, which no later step pairs.
    """

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            yield pa.RecordBatch.from_arrays([pa.array(_keys(batch).ravel().view(np.int64))], ["key"])

    signs = classes.select("node", *names)
    counted = signs.mapInArrow(every, "key long").groupBy("key").agg(F.count("*").alias("n"))
    shared = spark.sparkContext.broadcast(packed(field_of(counted.where("n > 1"), "key", FILTER_BITS)))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = opened(shared.value)
        for batch in text_slices(batches, 4096):
            keys = _keys(batch)
            row, at = np.nonzero(held(field, keys))
            nodes = batch.column(0).to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row, at].view(np.int64)), pa.array(at.astype(np.int32)), pa.array(nodes)],
                ["bucket", "at", "node"],
            )

    return stored(spark, signs.mapInArrow(passed, "bucket long, at int, node long"), "buckets")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    percent = round(100 * similarity)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            left, right = split_words(batch.column(2)), split_words(batch.column(3))
            keep = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                x, y = shingle_set(left.row(r), shingle), shingle_set(right.row(r), shingle)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep[r] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(confirm, "a long, b long")


def _class_texts(spark: SparkSession, docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(node, text): one text of every needed class.

    A task passes each class on once, so copies do not move, and texts meet the needed classes
    by their class alone: each of those stands there once, whatever the ids of the rows.
    """

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in text_slices(batches):
            words = split_words(batch.column(0))
            nodes, new = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                values = shingle_set(words.row(r), shingle)
                if len(values) and (node := set_hash(values)) not in seen:
                    seen.add(node)
                    nodes[r], new[r] = node, True
            found = pa.RecordBatch.from_arrays([pa.array(nodes), batch.column(0)], ["node", "text"])
            yield found.filter(pa.array(new))

    found = docs.select(F.col("text").cast("string")).mapInArrow(firsts, "node long, text string")
    found = found.join(needed, "node", "left_semi")
    return stored(spark, found.dropDuplicates(["node"]), "class-texts")


def _differences(both: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """main, node, root, gap, score, apart from (main, node, root, text, tc).

    apart: the shingles that only one of the texts ``text`` and ``tc`` has, gap: their number. Those
    of ``text`` come first: few others have them, while many lack the same ones of the center.
    Sets A and B are linked if their differences share (score of A + score of B) / 2 (100 + percent)
    shingles or more.
    """
    percent = round(100 * similarity)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts, centers = split_words(batch.column(3)), split_words(batch.column(4))
            sizes, apart = np.zeros(batch.num_rows, np.int64), []
            for r in range(batch.num_rows):
                values = shingle_set(texts.row(r), shingle)
                sizes[r] = len(values)
                center = shingle_set(centers.row(r), shingle)
                apart += [np.setdiff1d(x, y, assume_unique=True) for x, y in ((values, center), (center, values))]
            gaps = np.array([len(a) for a in apart], np.int64).reshape(-1, 2).sum(axis=1)
            ends = np.concatenate([[0], np.cumsum(gaps)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(apart).view(np.int64)))
            score = (100 + percent) * gaps - (100 - percent) * sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(gaps), pa.array(score), lists], ["main", "node", "root", "gap", "score", "apart"]
            )

    both = both.select("main", "node", "root", "text", "tc")
    return both.mapInArrow(compare, "main long, node long, root long, gap long, score long, apart array<long>")


def _seldom_first(spark: SparkSession, apart: DataFrame) -> DataFrame:
    """The same rows, their differences in an order common to the group: what many have comes last.

    The order decides only how many candidates there are, so a quarter of the members may give it.
    """
    some = apart.where(F.pmod("node", F.lit(4)) == 0).select("main", F.explode("apart").alias("item"))
    keys = some.select(F.col("main").bitwiseXOR(F.col("item")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    keys = stored(spark, keys.where("n > 1"), "often")
    fields = [packed(field_of(keys.where(F.col("n") > n), "key", FILTER_BITS)) for n in OFTEN]
    discard(spark, keys)
    shared = spark.sparkContext.broadcast(fields)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [opened(value) for value in shared.value]
        for batch in text_slices(batches):
            gaps = batch.column(3).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), gaps)
            items = batch.column(5).flatten().to_numpy().view(np.uint64)
            keys = items ^ batch.column(0).to_numpy().view(np.uint64)[row]
            many = sum(held(field, keys).astype(np.int8) for field in fields)
            ends = pa.array(np.concatenate([[0], np.cumsum(gaps)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(items[np.lexsort((many, row))].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], lists], batch.schema.names)

    return apart.mapInArrow(order, apart.schema)


def _sharing(spark: SparkSession, apart: DataFrame, similarity: float, scratch: list[DataFrame]) -> DataFrame:
    """Pairs (a, b) of different components whose differences may share enough.

    Of gap shingles, need of which are shared, the first shared one in any common order is at
    most at position gap - need, counted from 0. A member's need is the smallest that a partner leaves it.
    """
    twice = 2 * (100 + round(100 * similarity))

    def need(a: str, b: str) -> Column:
        return F.greatest(F.lit(1), F.ceil((F.col(a) + F.col(b)) / twice))

    minor = F.col("root") != F.col("main")
    bounds = apart.groupBy("main").agg(
        F.min("score").alias("least"),
        F.min(F.when(minor, F.col("score"))).alias("outside"),
        F.min_by(F.struct("node", "root"), F.struct("score", "node")).alias("best"),
    )
    known = _seldom_first(spark, apart).join(F.broadcast(bounds), "main")
    # Differences that need not share anything: both are linked with the nearest one.
    star = known.where((F.col("score") + F.col("least") <= 0) & (F.col("root") != F.col("best.root")))
    star = star.select(F.least("node", "best.node").alias("a"), F.greatest("node", "best.node").alias("b"))

    ends = known.withColumn("p_end", F.when(minor, F.col("gap") - need("score", "least") + 1).otherwise(0))
    ends = ends.withColumn("q_end", F.col("gap") - need("score", "outside") + 1)
    head = F.slice("apart", F.lit(1), F.greatest(F.lit(0), "p_end", "q_end").cast("int"))
    early = ends.select("main", "node", "root", "gap", "score", "p_end", "q_end", F.posexplode(head).alias("at", "item"))
    early = early.withColumn("first", F.col("at") < F.col("p_end")).withColumn("second", F.col("at") < F.col("q_end"))
    early = early.withColumn("left", F.col("gap") - F.col("at"))
    early = stored(spark, early.select("main", "item", "node", "root", "score", "left", "first", "second"), "early")
    scratch.append(early)
    p = early.where("first").select("main", "item", *[F.col(c).alias(f"p_{c}") for c in ("node", "root", "score", "left")])
    q = early.where("second").select("main", "item", *[F.col(c).alias(f"q_{c}") for c in ("node", "root", "score", "left")])
    once = (F.col("q_root") == F.col("main")) | (F.col("p_root") < F.col("q_root"))
    met = p.join(q, ["main", "item"]).where(once & (F.least("p_left", "q_left") >= need("p_score", "q_score")))
    met = met.select(F.least("p_node", "q_node").alias("a"), F.greatest("p_node", "q_node").alias("b"))
    return met.unionByName(star).distinct()


class _Links:
    """Rounds of candidate pairs over the buckets, with the links they have confirmed."""

    def __init__(self, spark, classes, texts, shingle, similarity, chunks) -> None:
        self.spark, self.classes, self.texts = spark, classes, texts
        self.shingle, self.similarity, self.columns = shingle, similarity, chunk_columns(chunks)
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None
        self.scratch: list[DataFrame] = []  # what is deleted when all links are found

    def signed(self, side: str, frame: DataFrame, node: str, signs: DataFrame | None = None) -> DataFrame:
        """``frame`` with the set size and signature of ``node`` under names of its side."""
        signs = self.classes if signs is None else signs
        names = [F.col(c).alias(f"{side}_{c}") for c in signs.columns if c != "node"]
        return frame.join(signs.select(F.col("node").alias(node), *names), node)

    def mixed(self, buckets: DataFrame) -> DataFrame:
        """(bucket, at, node, root, main) of buckets that hold more than one component.

        main is the bucket's component with the most members, of several the smallest.
        """
        named = buckets.select("bucket", "at", "node")
        if self.roots is None:
            named = named.withColumn("root", F.col("node"))
        else:
            named = named.join(self.roots.withColumnRenamed("root", "_root"), "node", "left")
            named = named.select("bucket", "at", "node", F.coalesce("_root", "node").alias("root"))
        counts = named.groupBy("bucket", "root").agg(F.count("*").alias("n"))
        most = counts.groupBy("bucket").agg(F.max("n").alias("n"), F.count("*").alias("roots"))
        most = most.where("roots > 1").drop("roots")
        main = counts.join(most, ["bucket", "n"]).groupBy("bucket").agg(F.min("root").alias("main"))
        return stored(self.spark, named.join(main, "bucket"), "mixed")

    def confirm(self, pairs: DataFrame) -> bool:
        """Confirm pairs (a, b), take in the links; whether there were any."""
        found = stored(self.spark, _verified(pairs, self.texts, self.shingle, self.similarity), "links")
        self.scratch.append(found)
        if found.isEmpty():
            return False
        self.links = found if self.links is None else self.links.unionByName(found)
        before, self.roots = self.roots, connected_components(self.spark, self.links)
        discard(self.spark, before)
        return True

    def first_pairs(self, buckets: DataFrame) -> DataFrame:
        """Each member with that of its bucket which meets the most others, so that few hubs serve many buckets.

        Among near copies of one text that is the text itself or what stands nearest to it, and
        what is linked with it becomes one component at once.
        """
        sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        shared = stored(self.spark, buckets.select("bucket", "node").join(sizes, "bucket"), "shared")
        self.scratch.append(shared)
        met = shared.groupBy("node").agg(F.sum("n").alias("met"))
        hubs = shared.join(met, "node").groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("hub"))
        pairs = shared.join(hubs, "bucket").where("node <> hub").select("node", "hub").distinct()
        return self.within(pairs)

    def hub_pairs(self, mixed: DataFrame, turn: int) -> DataFrame:
        """Each node outside a main component with one member of one, in changing order."""
        order = F.xxhash64("bucket", F.lit(turn))
        hubs = mixed.where("root = main").groupBy("bucket").agg(F.min(order.bitwiseXOR(F.col("node"))).alias("h"))
        hubs = hubs.select("bucket", order.bitwiseXOR(F.col("h")).alias("hub"))
        outside = mixed.where("root <> main").select("bucket", "node")
        return self.within(outside.join(hubs, "bucket").groupBy("node").agg(F.min("hub").alias("hub")))

    def within(self, pairs: DataFrame) -> DataFrame:
        """Pairs (node, hub) as (a, b), if they are within the signature distance."""
        both = self.signed("q", self.signed("p", pairs, "node"), "hub")
        both = both.where(_near(self.columns, self.similarity, ("p_n_shingles", "q_n_shingles")))
        return both.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))

    def rest(self, mixed: DataFrame) -> DataFrame:
        """Pairs of different components that may be linked; with those that are, no link is lost."""
        sizes = mixed.groupBy("bucket", "main").agg(
            F.count("*").alias("n"), F.count(F.when(F.col("root") != F.col("main"), 1)).alias("minor")
        )
        tests = sizes.groupBy("main").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("minor")).alias("tests"))
        dense = stored(self.spark, tests.where(F.col("tests") > LISTED * F.col("rows")).select("main"), "dense")
        self.scratch.append(dense)
        if dense.isEmpty():
            return self.listed(mixed)
        near = self.by_center(mixed.join(F.broadcast(dense), "main").join(sizes.select("bucket", "n"), "bucket"))
        return self.listed(mixed.join(F.broadcast(dense), "main", "left_anti")).unionByName(near)

    def by_center(self, mixed: DataFrame) -> DataFrame:
        """Pairs whose differences from their main component's center allow the similarity, each once.

        The center is the member that meets the most others, counted over the buckets; ``mixed``
        has the size n of every row's bucket.
        """
        members = mixed.groupBy("main", "node").agg(F.min("root").alias("root"), F.sum("n").alias("met"))
        members = stored(self.spark, members, "dense-members")
        centers = members.groupBy("main").agg(F.max_by("node", F.struct("met", "node")).alias("center"))
        centers = centers.join(self.texts.select(F.col("node").alias("center"), F.col("text").alias("tc")), "center")
        centers = stored(self.spark, centers.select("main", "tc"), "centers")
        texts = self.texts.select("node", "text")
        both = members.select("main", "node", "root").join(texts, "node").join(centers, "main")
        apart = stored(self.spark, _differences(both, self.shingle, self.similarity), "differences")
        self.scratch += [members, centers, apart]
        return _sharing(self.spark, apart, self.similarity, self.scratch)

    def listed(self, mixed: DataFrame) -> DataFrame:
        """All pairs of different components within the distance, each once.

        One side is only the members outside their bucket's main component. Both sides are
        read from files, so the join on the bucket has exchanges that can be split.
        """
        ours = mixed.select("bucket", "at", F.col("node").alias("p"), F.col("root").alias("pr"), "main")
        few = stored(self.spark, self.signed("p", ours.where("pr <> main"), "p"), "minor")
        theirs = mixed.select("bucket", F.col("node").alias("q"), F.col("root").alias("qr"))
        every = stored(self.spark, self.signed("q", theirs, "q"), "members")
        near = _near(self.columns, self.similarity, ("p_n_shingles", "q_n_shingles"))
        once = (F.col("qr") == F.col("main")) | (F.col("pr") < F.col("qr"))
        on = (few["bucket"] == every["bucket"]) & once
        # In this order: the first test is the cheapest and leaves one in many.
        cross = few.join(every, on & _first_shared(self.columns) & near)
        pairs = cross.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
        pairs = stored(self.spark, pairs, "pairs")
        discard(self.spark, few, every)
        left = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        fine = fine_signatures(self.texts.join(left, "node", "left_semi"), self.shingle)
        signs = stored(self.spark, self.classes.select("node", "n_shingles").join(fine, "node"), "fine")
        self.scratch += [pairs, signs]
        return _fine_pairs(pairs, signs, -(-signs.count() // BLOCK) or 1, self.similarity)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, cls for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links lead to. Null, empty and blank texts have
    no shingles and link with nothing (cls null, component_id their own doc_id). Repeated
    rows are one class; equal ids with different texts are told apart by their texts. A null
    doc_id never becomes a component id unless its component has no other. Other columns of
    ``docs`` are not read, whatever their names.
    """
    return _answer(*_solved(spark, docs, shingle, similarity))


def _solved(spark: SparkSession, docs: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, n_shingles, cls) of every row, and (node, root) of classes with links, if any."""
    chunks = layout(similarity)
    signed = stored(spark, signatures(docs, shingle, chunks), "signatures")
    names = chunk_columns(chunks)
    classes = (
        signed.where("cls is not null")
        .groupBy(F.col("cls").alias("node"))
        .agg(F.first("n_shingles").alias("n_shingles"), *[F.first(n).alias(n) for n in names])
    )
    classes = stored(spark, classes, "classes")
    ids = stored(spark, signed.select("doc_id", "n_shingles", "cls"), "ids")
    discard(spark, signed)
    buckets = _buckets(spark, classes, names)
    if buckets.isEmpty():
        return ids, None
    texts = _class_texts(spark, docs, buckets.select("node").distinct(), shingle)
    links = _Links(spark, classes, texts, shingle, similarity, chunks)
    found = links.confirm(links.first_pairs(buckets))
    mixed = links.mixed(buckets)
    discard(spark, buckets)
    for turn in range(1, HUB_ROUNDS):
        if not found or mixed.isEmpty():
            break
        if found := links.confirm(links.hub_pairs(mixed, turn)):
            before, mixed = mixed, links.mixed(mixed)
            discard(spark, before)
    if not mixed.isEmpty():
        links.confirm(links.rest(mixed))
    discard(spark, mixed, texts, classes, *links.scratch)
    return ids, links.roots


def _components(ids: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(cls, root, least): the component of every class and its smallest doc_id."""
    smallest = ids.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    if roots is None:
        return smallest.select("cls", F.col("cls").alias("root"), "least")
    tops = roots.select(F.col("node").alias("cls"), "root")
    joined = smallest.join(tops, "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    over = joined.groupBy("root").agg(F.min("least").alias("component"))
    return joined.join(over, "root").select("cls", "root", F.col("component").alias("least"))


def _answer(ids: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Documents with their component; ids meet components by class, never as pairs."""
    component = F.coalesce("least", "doc_id")
    return ids.join(_components(ids, roots).drop("root"), "cls", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "cls",
    )


def _classed(docs: DataFrame, shingle: int, contested=None) -> DataFrame:
    """(row, cls, open): every row as a struct of all its columns, and the hash of its shingle set.

    open: whether the class may be contested, that is, share its component with another row.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = opened(contested.value)
        for batch in text_slices(batches):
            words = split_words(batch.column(0).flatten()[at].cast(pa.string()))
            sets = [shingle_set(words.row(r), shingle) for r in range(batch.num_rows)]
            cls = np.array([set_hash(v) if len(v) else 0 for v in sets], np.int64)
            blank = np.array([not len(v) for v in sets])
            open_ = held(field, cls.view(np.uint64)) & ~blank
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, mask=blank), pa.array(open_)], ["row", "cls", "open"]
            )

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    fields = [rows.schema["row"], T.StructField("cls", T.LongType()), T.StructField("open", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType(fields))


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component, all columns.

    The row with the smallest doc_id stays, of several with that id the first by text; a null
    id counts after all others. Rows without words link with nothing, so each of them stays.
    Rows that are alone in their component stay where they are read; only the others move.
    """
    ids, roots = _solved(spark, docs, shingle, similarity)
    tops = _components(ids, roots)
    rows = ids.where("cls is not null").groupBy("cls").agg(F.count("*").alias("n"))
    many = tops.join(rows, "cls").groupBy("root").agg(F.sum("n").alias("rows")).where("rows > 1")
    tops = stored(spark, tops.join(many.select("root"), "root", "left_semi"), "components")
    contested = spark.sparkContext.broadcast(packed(field_of(tops, "cls", FILTER_BITS)))
    every = _classed(docs, shingle, contested)
    alone = every.where("not open").select("row")
    # A row that passed the field by chance meets no component and stays as well.
    met = every.where("open").join(tops, "cls", "left")
    single = F.when(F.col("root").isNull(), F.monotonically_increasing_id())
    met = met.where(F.col("root").isNull() | F.col("row.doc_id").cast("long").eqNullSafe(F.col("least")))
    first = F.min_by("row", F.struct("row.doc_id", "row.text"))
    kept = met.groupBy("root", single.alias("single")).agg(first.alias("row")).select("row")
    return alone.unionByName(kept).select("row.*")
