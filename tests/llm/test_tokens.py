"""BPE and token files against the tokenizers library, with round trips."""

from __future__ import annotations

import hashlib
import random
import zlib
from hashlib import blake2b

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerwide.llm import bpe, token_files
from ledgerwide.llm.chunks import SIGNS, ChunkStore
from ledgerwide.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n=800):
    r = random.Random(4)
    alphabet = list(SIGNS) + [
        "a", "b", "The", "'s", "'T", " ", "\n", "\x1c", "\x85", "\xa0", "​", "é", "é", "İ", "ΑΣ", "ß", "中",
        "ᄒ", "ᅡ", "9", "٣", "²", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "̀", "ſ", "क़",
    ]
    mixed = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return mixed + ["", "a" * 3000, "abab" * 900, "aaaa aaaaa aaaaaaa'", "word, word. Word! WORD"]


def test_ids_and_decoding_equal_the_library(library):
    own = bpe.WordBpe(open(PATH).read())
    texts = odd_texts()
    for text, ids in zip(texts, ChunkStore(own.encode_chunks).of_texts(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_query_columns(spark, library):
    texts = odd_texts(50) + [None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.digests(bpe.encode(spark, docs, PATH)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        body = np.array(ids, "<u4").tobytes()
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(body).hexdigest()
        whole = library.decode(ids, skip_special_tokens=False).encode()
        assert got[i].decoded_sha256 == hashlib.sha256(whole).hexdigest()


def test_files_give_back_every_document(spark, library):
    rows = [(7 * i % 61, t) for i, t in enumerate(odd_texts(55)[:60])] + [(None, "no key"), (9, "again"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_path(spark, "ids")
    manifest = token_files.write_tokens(spark, docs, folder, PATH, 2, shards=3)
    got = token_files.digests(token_files.read_tokens(spark, manifest, folder)).collect()
    start, want = 0, []
    encoded = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    digest = lambda ids: blake2b(np.array(ids, "<u2").tobytes(), digest_size=8).digest()[::-1]
    for d, ids in sorted(encoded, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1]))):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    keys = spark.createDataFrame([(9,), (3,), (None,), (10**9,), (-5,)], "doc_id long")
    found = token_files.lookup(spark, manifest, folder, keys).collect()
    assert sorted((r.doc_id, r.start) for r in found) == sorted((d, s) for d, s, *_ in want if d in (9, 3))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = scratch_path(spark, "ids")
    manifest = token_files.write_tokens(spark, docs, folder, PATH, 2, shards=2)
    assert token_files.read_tokens(spark, manifest, folder).collect() == []
    assert bpe.encode(spark, docs, PATH).collect() == []


def test_one_key_and_null_keys_over_several_shards(spark, library):
    rows = [(5, f"hot {i}") for i in range(300)] + [(None, f"none {i}") for i in range(200)]
    rows += [(i, f"own {i}") for i in range(300)] + [(5, "hot 7")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = scratch_path(spark, "ids")
    manifest = token_files.write_tokens(spark, docs, folder, PATH, 2, shards=8).orderBy("part").collect()
    assert max(m.docs for m in manifest) < 250 and sum(m.docs for m in manifest) == len(rows)
    assert sum(m.low == 5 or m.high == 5 for m in manifest) > 2
    table = spark.createDataFrame(manifest, token_files.MANIFEST)
    got = token_files.read_tokens(spark, table, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    want = [np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for _, t in rows]
    assert sorted(bytes(r.ids) for r in got) == sorted(want)
    keys = spark.createDataFrame([(5,), (299,)], "doc_id long")
    found = token_files.lookup(spark, table, folder, keys).collect()
    assert sorted((r.doc_id, r.start) for r in found) == sorted((r.doc_id, r.start) for r in got if r.doc_id in (5, 299))


def test_words_side_by_side_and_a_small_store(library):
    source = open(PATH, encoding="utf-8").read()
    store = ChunkStore(token_files._library_encoder(source, 2), limit=20_000)
    texts = odd_texts(1500) + ["x" * 40 + " " + "many words in one text " * 60_000, None]
    for text, ids in zip(texts, store.of_texts(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert store.known.size < 20_000 or len(store.known.young) < 5_000


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.uint64)
    index = token_files.perfect_hash(keys)
    assert sorted(token_files.numbers(index, keys).tolist()) == list(range(n))


def test_chunks_are_looked_up_by_group_and_learned_once():
    asked = []

    def encode(parts):
        asked.extend(parts)
        return [f"[{p}]".encode() for p in parts]

    store = ChunkStore(encode)
    assert list(store.of_texts(["Word, word word. É. É 12. ...", None, "WORD, É. 12."])) == [
        "[word][,][word][word][.][É][.][É][12.][...]".encode(), b"", "[word][,][É][.][12.]".encode(),
    ]
    assert sorted(asked) == sorted({*asked}) == sorted(["word", ",", ".", "É", "12.", "..."])
    assert store.known.missing(["WORD,", "new"], iter(["newer", "É."])) == {"new", "newer"}
