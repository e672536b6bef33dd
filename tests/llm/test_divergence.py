"""Source divergence against plain counts; transducers against sorted lists."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerwide.llm import divergence
from ledgerwide.llm.queries import SQL

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, least):
    counts, frequencies = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        frequencies[lang or ""].update(set(terms))
    kept = {lang: [t for t, n in f.items() if n >= least] for lang, f in frequencies.items()}
    share = lambda n, total, terms: 1 + 10**9 * (n + 5) // (total + 5 * terms)
    rows = []
    for lang, terms in kept.items():
        own = {s: c for (g, s), c in counts.items() if g == lang}
        shares = {s: {t: share(c[t], sum(c[x] for x in terms), len(terms)) for t in terms} for s, c in own.items()}
        every = Counter()
        for c in own.values():
            every.update(c)
        total = sum(every[t] for t in terms)
        whole = {t: share(every[t], total, len(terms)) for t in terms}
        for s, p in shares.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in terms), o) for o, q in shares.items() if o != s]
            above = [(p[t] - whole[t], t) for t in terms if own[s][t] > 0 and p[t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", above, 50)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                rows += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(rows)


def corpus(r):
    words = ["Éa", "ÉA", "abc", "ABC", "ab", "a", "zz", "z9z", "日本", "日", "it's", "\x85x", " ", "é", "é", "b-c"]
    words += ["".join(r.choice("abé") for _ in range(r.randint(1, 6))) for _ in range(150)]
    docs = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else r.choice(["s1", "s2", "", None, "S1", "é"])
        text = r.choice([" ", "\n", "-", "1"]).join(r.choice(words[: r.choice([20, 166])]) for _ in range(r.randint(0, 40)))
        docs.append((r.choice(["en", "en", "fr", None, ""]), source, text))
    docs += [("xx", "one", "rare words only"), ("xx", "two", None), ("yy", "alone", ""), ("en", "blank", " 12 "), ("en", None, None)]
    docs += [("en", "long", "q" * 70_000 + " tail")] * 6 + docs[:20]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_counts(spark, monkeypatch, small):
    if small:  # several blocks to a language, several packs, chunks of few terms, parts of counts
        for name, value in {"BLOCK_TERMS": 7, "PACK_BYTES": 6000, "PAIR_CELLS": 20, "COUNTS_HELD": 50, "TERMS_HELD": 60}.items():
            monkeypatch.setattr(divergence, name, value)
        monkeypatch.setattr(divergence, "STREAM_BYTES", 300)
    docs = corpus(random.Random(4))
    frame = spark.createDataFrame([(*d, 1, "t") for d in docs], "lang string, source string, text string, n int, `term.x` string")
    got = divergence.divergence(spark, frame, least_documents=5).collect()
    assert sorted(map(tuple, got)) == plain(docs, 5) and len(got) > 300
    assert dict(divergence.divergence(spark, frame).dtypes) == {
        "lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int",
    }


def test_empty_table_and_no_kept_terms(spark):
    schema = "lang string, source string, text string"
    assert divergence.divergence(spark, spark.createDataFrame([], schema)).isEmpty()
    few = spark.createDataFrame([("en", "a", "x"), ("en", "b", "x"), ("fr", None, None)], schema)
    assert sorted(map(tuple, divergence.divergence(spark, few).collect())) == [
        ("en", "a", "pair", "b", 0, 1),
        ("en", "b", "pair", "a", 0, 1),
    ]


def test_transducers_are_minimal_and_give_places_in_order():
    r = random.Random(9)
    for _ in range(40):
        terms = sorted({bytes(r.choice(b"abc") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 60))})
        builder = divergence.Builder()
        for t in terms:
            builder.add(t)
        packed = builder.packed()
        prefixes = {t[:k] for t in terms for k in range(len(t) + 1)}
        endings = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in prefixes}
        assert len(builder.edges) - 1 == len(endings)
        tokens = terms + [t + b"a" for t in terms] + [t[:-1] for t in terms if len(t) > 1] + [b"zzz", b"cab"]
        data = np.frombuffer(b" ".join(tokens) + b" ", np.uint8)
        end = np.cumsum([len(t) + 1 for t in tokens]) - 1
        begin = end - np.array([len(t) for t in tokens])
        whole = divergence.Transducer.of(100, packed["root"], packed["edges"], packed["finals"])
        sparse = divergence.Transducer(**{**whole.__dict__, "dense": False})
        sparse.targets, sparse.weights = whole.targets[whole.keys], whole.weights[whole.keys]
        for transducer in (whole, sparse):
            token, ordinal = transducer.ordinals(data, begin, end)
            got = dict(zip(token.tolist(), ordinal.tolist()))
            assert got == {i: 100 + terms.index(t) for i, t in enumerate(tokens) if t in terms}


def test_twin_is_registered():
    assert "op11_source_divergence" in SQL
