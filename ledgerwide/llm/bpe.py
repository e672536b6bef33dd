"""BPE encoding and decoding with batched numpy merge rounds.

All symbols of many words lie in one flat array. A round looks every adjacent pair up by
binary search over the sorted pair keys, takes each word's lowest rank and merges all its
places at once, left to right where they overlap; words without a further pair leave the
array. That equals merging one pair at a time, since a merge only ever makes pairs of later
rank. Text is first brought to the vocabulary's normal form and cut by its pattern, with
letters and numbers as of the installed Unicode tables.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.chunks import SPACE, ChunkStore
from ledgerwide.llm.words import text_slices

NEVER = np.iinfo(np.int64).max
#: Lower case where str.lower() differs, by place in a word or by Unicode version.
LOWER = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3}
LOWER |= {0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def byte_characters() -> list[str]:
    """The printable stand-in of every byte: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)]


class WordBpe:
    """A vocabulary file of byte symbols with word ends, as read from its JSON text."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.size = len(self.names)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", SPACE))
        self.known: dict[str, bytes] = {}

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian unsigned 32-bit integers."""
        cut = [self._pieces(c) for c in chunks]
        new = list({p for parts in cut for p in parts if isinstance(p, str)})
        ids = dict(zip(new, self.encode_pieces(new)))
        return [b"".join(p if isinstance(p, bytes) else ids[p] for p in parts) for parts in cut]

    def _pieces(self, chunk: str) -> list[str | bytes]:
        if self.marks is not None and "<" in chunk and self.marks.search(chunk):
            out: list[str | bytes] = []
            for part in self.marks.split(chunk):
                out += [self.special[part]] if part in self.special else self._plain(part)
            return out
        return self._plain(chunk)

    def _plain(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).translate(LOWER)
        return self.pieces.findall(chunk.lower())

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lengths)
        body = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[body]
        symbols[ends - 1] = self.last[body[ends - 1]]
        words = np.repeat(np.arange(len(raw)), lengths)
        symbols, words = self.merge(symbols, words)
        flat = symbols.astype("<u4")
        bounds = np.searchsorted(words, np.arange(len(raw) + 1))
        return [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of all words, with the word of each, in order of words."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            keys = np.where(words[1:] == words[:-1], symbols[:-1] * self.size + symbols[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.full(len(symbols), NEVER)
            rank[:-1] = np.where(self.keys[at] == keys, self.ranks[at], NEVER)
            starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(symbols)])
            each = np.repeat(lowest, counts)
            live = each != NEVER
            if not live.all():
                done.append((symbols[~live], words[~live]))
            hit = np.flatnonzero(live & (rank == each))
            if not len(hit):
                break
            # In a run of overlapping places every second one merges, from the left.
            fresh = np.r_[True, (np.diff(hit) != 1) | (words[hit[1:]] != words[hit[:-1]])]
            since = np.arange(len(hit)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            hit = hit[since % 2 == 0]
            symbols[hit] = self.made[at[hit]]
            live[hit + 1] = False
            symbols, words = symbols[live], words[live]
        if not done:
            return symbols, words
        symbols = np.concatenate([s for s, _ in done])
        words = np.concatenate([w for _, w in done])
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), decoded text of every row of ``docs``.

    ``path`` is the vocabulary file; the driver reads it and its fixed size makes it fit for
    a broadcast. Null and empty texts have no ids. Repeated rows and equal or null doc_ids
    are rows like others. Special tokens in a text get their own id, as the format says.
    Other columns of ``docs`` are not read. Texts of any length are one value each.
    """
    with open(path, encoding="utf-8") as file:
        state = spark.sparkContext.broadcast({"source": file.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = state.value  # one object in a worker, so what it has encoded stays known
        if "bpe" not in mine:
            mine["bpe"] = WordBpe(mine["source"])
            mine["store"] = ChunkStore(mine["bpe"].encode_chunks)
        for batch in text_slices(batches, 256):
            ids = list(mine["store"].of_texts(batch.column(1).to_pylist()))
            texts = list(map(mine["bpe"].decode, ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame, *carried: str) -> DataFrame:
    return encoded.select(
        "doc_id",
        *carried,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
