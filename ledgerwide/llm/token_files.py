"""Token ids in binary shards with a minimal perfect hash from document key to offset.

A shard holds documents in ascending doc_id order, and shards follow each other in that order.
Layout, all little-endian: ids of all documents (16 or 32 bits each), then arrays, then a JSON
table of the arrays' places, its length and a magic word. The index of a shard is a minimal
perfect hash: levels of bit arrays, a key standing at the first level where it met no other,
and its number being the set bits before it. At that number lie a 32-bit fingerprint of the
key and the row of its document, so a lookup takes constant time and no stored key.

Tasks write shards straight to the shared folder under fresh names; a shard counts only once
its line is in the manifest, which is written from the finished tasks. Attempts of lost
executors leave files that nothing names.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.chunks import ChunkStore
from ledgerwide.llm.tables import stored
from ledgerwide.llm.words import mix, text_slices

MAGIC = b"LWIDS001"
SPREAD = 2  # bits a level has for each key left
PRINT_SEED = np.uint64(0xA0761D6478BD642F)
SKETCH = 200, 4096  # least and greatest width of the sketch that bounds the shards
JOINED = 256  # words of letters that the library encodes as one text
ENCODED = "part int, doc_id long, order long, ids binary"
MANIFEST = "part int, file string, docs long, ids long, width int, low long, high long"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder name with or without a scheme."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:") :]
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full name: one without a scheme lies on Hadoop's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _at_level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mix(np.array([level + 1], np.uint64))
    return (mix(keys ^ seed) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Levels, bits and ranks of a minimal perfect hash of distinct 64-bit keys."""
    sizes, bits = [], []
    left = keys
    while len(left):
        size = -(-SPREAD * len(left) // 64) * 64
        at = _at_level(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    flat = np.concatenate(bits) if bits else np.zeros(0, bool)
    words = flat.reshape(-1, 64).sum(axis=1)
    return {
        "level_sizes": np.array(sizes, np.int64),
        "bits": np.packbits(flat, bitorder="little"),
        "ranks": (np.cumsum(words) - words).astype(np.int64),
    }


def numbers(index: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Number of each key; keys that were not indexed give -1 or the number of another."""
    found = np.full(len(keys), -1, np.int64)
    words = index["bits"].view("<u8")
    base = 0
    for level, size in enumerate(index["level_sizes"].tolist()):
        open_ = np.flatnonzero(found < 0)
        if not len(open_):
            break
        at = base + _at_level(keys[open_], level, size)
        word, bit = words[at >> 6], (at & 63).astype(np.uint64)
        hit = (word >> bit) & np.uint64(1) == 1
        before = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        found[open_[hit]] = index["ranks"][at[hit] >> 6] + before[hit]
        base += size
    return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ PRINT_SEED) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Shard:
    """An open shard; documents are rows in order, found by key through the index."""

    file: pa.NativeFile
    width: int
    arrays: dict[str, np.ndarray]

    @classmethod
    def open(cls, system: fs.FileSystem, path: str) -> Shard:
        file = system.open_input_file(path)
        size = file.size()
        tail = file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a shard of token ids: {path}")
        length = int.from_bytes(tail[:8], "little")
        table = json.loads(file.read_at(length, size - 16 - length))
        arrays = {
            name: np.frombuffer(file.read_at(nbytes, at), np.dtype(kind))
            for name, (at, nbytes, kind) in table["arrays"].items()
        }
        return cls(file, table["width"], arrays)

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row of each key and how many rows share it; 0 rows for an unknown key."""
        keys = keys.view(np.uint64)
        at = numbers(self.arrays, keys)
        known = at >= 0
        at = np.where(known, at, 0)
        if not len(self.arrays["prints"]):
            return at, np.zeros(len(keys), np.int64)
        known &= self.arrays["prints"][at] == fingerprints(keys)
        first = self.arrays["first_row"][at]
        return first, np.where(known, self.arrays["row_count"][at], 0)

    def ids(self, row: int) -> np.ndarray:
        """Ids of a document, read from its offset alone."""
        return self.run_of_ids(row, row + 1)[0]

    def run_of_ids(self, first: int, last: int) -> list[np.ndarray]:
        """Ids of neighbouring documents in one read."""
        cuts = self.arrays["starts"][first : last + 1]
        body = self.file.read_at(int(cuts[-1] - cuts[0]) * self.width, int(cuts[0]) * self.width)
        ids = np.frombuffer(body, f"<u{self.width}").astype("<u4")
        return np.split(ids, cuts[1:-1] - cuts[0])


def _write_shard(system, path: str, width: int, keys, valid, starts, ids_stream) -> None:
    with system.open_output_stream(path) as out:
        at = 0
        for block in ids_stream:
            out.write(block)
            at += len(block)
        keys, valid = keys(), valid()
        bounds = starts()
        fresh = (keys[1:] != keys[:-1]) | (valid[1:] != valid[:-1])  # null keys are held as 0
        first = np.flatnonzero(np.r_[True, fresh] & valid) if len(keys) else np.zeros(0, np.int64)
        distinct = keys[first].view(np.uint64)
        arrays = perfect_hash(distinct)
        place = numbers(arrays, distinct)
        ends = np.r_[first[1:], len(keys)].astype(np.int64) if len(first) else first
        for name, values, kind in (
            ("prints", fingerprints(distinct), np.uint32),
            ("first_row", first, np.int64),
            ("row_count", ends - first, np.int64),
        ):
            arrays[name] = np.zeros(len(distinct), kind)
            arrays[name][place] = values
        arrays |= {"keys": keys, "valid": valid, "starts": bounds}
        table = {}
        for name, values in arrays.items():
            body = np.ascontiguousarray(values).tobytes()
            table[name] = (at, len(body), values.dtype.str)
            out.write(body)
            at += len(body)
        text = json.dumps({"width": width, "arrays": table}).encode()
        out.write(text + len(text).to_bytes(8, "little") + MAGIC)


def _library_encoder(source: str, width: int) -> Callable[[list[str]], list[bytes]]:
    """Ids of many parts at once, by the tokenizers library.

    Words of letters are encoded side by side in one text: each ends with a token that closes
    a word, so the ids part there. Where a text's closing tokens are not as many as its words,
    its words are encoded one by one, as are all other parts.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(source)
    library.no_truncation()
    library.no_padding()
    suffix = json.loads(source)["model"].get("end_of_word_suffix")
    vocabulary = library.get_vocab(True)
    closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    if suffix:
        closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    kind = np.dtype(f"<u{width}")

    def encode(parts: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {}
        words = [p for p in parts if p.isalpha()] if suffix else []
        groups = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        texts = library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, text in zip(groups, texts):
            ids = np.array(text.ids, np.int64)
            cuts = (np.flatnonzero(closes[ids]) + 1) * width
            if len(cuts) == len(group) and cuts[-1] == len(ids) * width:
                body, cuts = ids.astype(kind).tobytes(), cuts.tolist()
                out.update(zip(group, (body[a:b] for a, b in zip([0, *cuts], cuts))))
        rest = [p for p in parts if p not in out]
        texts = library.encode_batch_fast(rest, add_special_tokens=False)
        out.update((p, np.array(text.ids, kind).tobytes()) for p, text in zip(rest, texts))
        return [out[p] for p in parts]

    return encode


def _shard_bounds(rows: DataFrame, shards: int) -> tuple[int, np.ndarray]:
    """How many shards hold rows without a key, and the sorted key bounds between the others.

    The bounds are quantiles of one mergeable sketch over the keys alone; they only decide how
    evenly rows are dealt. A key that holds several shards' share is several bounds.
    """
    width = min(max(SKETCH[0], 4 * shards), SKETCH[1])
    sketch = F.kll_sketch_agg_bigint("doc_id", F.lit(width))
    seen = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("keyed"), sketch.alias("sketch")).first()
    unkeyed = -(-shards * (seen["n"] - seen["keyed"]) // max(seen["n"], 1))
    keyed = max(shards - unkeyed, 1)
    if keyed == 1 or not seen["keyed"]:
        return unkeyed, np.zeros(0, np.int64)
    ranks = F.array(*[F.lit(i / keyed) for i in range(1, keyed)])
    one = rows.sparkSession.createDataFrame([(seen["sketch"],)], "sketch binary")
    found = one.select(F.kll_sketch_get_quantile_bigint("sketch", ranks).alias("at")).first()["at"]
    return unkeyed, np.sort(np.array(found, np.int64))


SIGN = np.uint64(1 << 63)  # turns the order of unsigned numbers into that of signed ones


def _part_of(keys: pa.Array, order: np.ndarray, unkeyed: int, bounds: np.ndarray) -> np.ndarray:
    """Shard of each row: by key, and by ``order`` where a key may lie in several."""
    values = keys.fill_null(0).to_numpy()
    known = keys.is_valid().to_numpy(zero_copy_only=False)
    first = np.where(known, unkeyed + np.searchsorted(bounds, values, "left"), 0)
    last = np.where(known, unkeyed + np.searchsorted(bounds, values, "right"), max(unkeyed - 1, 0))
    share = (order >> np.uint64(32)).astype(np.int64)
    return (first + (share * (last - first + 1) >> 32)).astype(np.int32)


def write_tokens(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None
) -> DataFrame:
    """Encode whole texts into shards below ``folder`` and return the manifest.

    ``tokenizer`` is a vocabulary file of the tokenizers library, read on the driver and of
    fixed size; ``end_id`` closes every document. Null and empty texts hold the end alone.
    Null doc_ids come first and are found by position only, as they are no keys. Rows that
    repeat a doc_id lie together, ordered by a digest of their ids, and one key finds all of
    them; a doc_id with more rows than a shard's share is dealt over several shards by that
    digest. No rows give one empty manifest. Other columns of ``docs`` are not read. Texts are
    encoded where they lie, and only their ids are moved and sorted.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        source = file.read()
    width = 2 if max(Tokenizer.from_str(source).get_vocab_size(True) - 1, end_id) < 1 << 16 else 4
    state = spark.sparkContext.broadcast({"source": source})
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = qualified(spark, folder)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    unkeyed, bounds = _shard_bounds(rows, shards)
    parts = unkeyed + len(bounds) + 1
    end = np.array([end_id], f"<u{width}").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = state.value  # one object in a worker, so what it has encoded stays known
        if "store" not in mine:
            mine["store"] = ChunkStore(_library_encoder(mine["source"], width))
        for batch in text_slices(batches, 256):
            ids = [body + end for body in mine["store"].of_texts(batch.column(1).to_pylist())]
            order = np.frombuffer(b"".join(blake2b(body, digest_size=8).digest() for body in ids), "<u8")
            keys = batch.column(0)
            part = _part_of(keys, order, unkeyed, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), keys, pa.array((order ^ SIGN).view(np.int64)), pa.array(ids, pa.binary())],
                ["part", "doc_id", "order", "ids"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, valid, counts = [], [], []
        part = [-1]

        def blocks() -> Iterator[bytes]:
            for batch in text_slices(batches, 512):
                if part[0] < 0:
                    part[0] = batch.column(0)[0].as_py()
                column, ids = batch.column(1), batch.column(3).to_pylist()
                valid.append(column.is_valid().to_numpy(zero_copy_only=False))
                keys.append(column.fill_null(0).to_numpy())
                counts.append(np.fromiter(map(len, ids), np.int64, len(ids)) // width)
                yield b"".join(ids)

        def joined(parts: list, dtype) -> np.ndarray:
            return np.concatenate(parts) if parts else np.zeros(0, dtype)

        name = f"shard-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.ids"
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        _write_shard(
            system,
            f"{root}/{name}",
            width,
            lambda: joined(keys, np.int64),
            lambda: joined(valid, bool),
            lambda: np.r_[0, np.cumsum(joined(counts, np.int64))].astype(np.int64),
            blocks(),
        )
        ids, ok = joined(keys, np.int64), joined(valid, bool)
        known = ids[ok]
        line = [part[0], name, len(ids), int(joined(counts, np.int64).sum()), width]
        line += [int(known[0]), int(known[-1])] if len(known) else [None, None]
        schema = pa.schema(
            [("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]
            + [("width", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]
        )
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(line, schema)], schema=schema)

    dealt = rows.mapInArrow(encoded, ENCODED).repartitionById(parts, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", "doc_id", "order", "ids")
    return stored(spark, ordered.mapInArrow(write, MANIFEST), "token-manifest")


def _bases(manifest: DataFrame) -> list[tuple]:
    """Shards in order with the ids before each: one line per shard, never per document."""
    lines, base = [], 0
    for r in sorted(manifest.where("docs > 0").collect(), key=lambda r: r["part"]):
        lines.append((r["part"], r["file"], base, r["low"], r["high"]))
        base += r["ids"]
    return lines


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, ids of every document, each fetched through its shard's index.

    start counts the ids of all documents before it; ids are little-endian unsigned 32-bit.
    """
    folder = qualified(spark, folder)
    lines = [line[:3] for line in _bases(manifest)]
    tasks = spark.createDataFrame(lines, "part int, file string, base long")
    tasks = tasks.repartition(max(1, len(lines)), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                shard = Shard.open(system, f"{root}/{name}")
                yield from _documents(shard, base)

    return tasks.mapInArrow(run, "doc_id long, start long, ids binary")


def _documents(shard: Shard, base: int, block: int = 512) -> Iterator[pa.RecordBatch]:
    keys, valid = shard.arrays["keys"], shard.arrays["valid"]
    row = np.arange(len(keys))
    first, count = shard.rows_of(keys)
    lead = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (valid[1:] != valid[:-1])])
    offset = row - np.repeat(lead, np.diff(np.r_[lead, len(keys)]))
    if not ((offset < count) | ~valid).all():
        raise ValueError("a document's key is not in the index of its shard")
    row = np.where(valid, first + offset, row)
    for at in range(0, len(row), block):
        part = row[at : at + block]
        ids = shard.run_of_ids(int(part[0]), int(part[-1]) + 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[at : at + block], mask=~valid[at : at + block]),
                pa.array(shard.arrays["starts"][part] + base),
                pa.array([ids[r].tobytes() for r in (part - part[0]).tolist()], pa.binary()),
            ],
            ["doc_id", "start", "ids"],
        )


def _between(first: np.ndarray, last: np.ndarray) -> list[int]:
    """Every number that lies in one of the closed spans."""
    return sorted({s for a, b in set(zip(first.tolist(), last.tolist())) for s in range(a, b + 1)})


def lookup(spark: SparkSession, manifest: DataFrame, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, start, ids for every row of ``keys`` (doc_id) that is a stored document's key.

    The shard follows from the manifest's key ranges, a document from its shard's index.
    Null and unknown keys give no row; a repeated key gives its documents again.
    """
    folder = qualified(spark, folder)
    held = [line for line in _bases(manifest) if line[3] is not None]
    lows = np.array([line[3] for line in held], np.int64)
    highs = np.array([line[4] for line in held], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        for batch in batches:
            wanted = batch.column(0).drop_null().to_numpy()
            since, last = np.searchsorted(highs, wanted, "left"), np.searchsorted(lows, wanted, "right") - 1
            for s in _between(since, last):
                shard = Shard.open(system, f"{root}/{held[s][1]}")
                mine = wanted[(since <= s) & (s <= last)]
                first, count = shard.rows_of(mine)
                rows = [r for f, c in zip(first.tolist(), count.tolist()) for r in range(f, f + c)]
                starts = [int(shard.arrays["starts"][r]) + held[s][2] for r in rows]
                ids = [shard.ids(r).tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(mine, count)), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    return keys.select(F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, start long, ids binary")


def digests(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
