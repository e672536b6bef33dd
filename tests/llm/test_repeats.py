"""Removal of repeated passages against a count of all windows; the automaton against substrings."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from ledgerwide.llm import repeats
from ledgerwide.llm.automaton import SuffixAutomaton


def plain(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def corpus(r):
    draw = lambda n, k=400: [f"w{r.randint(0, k)}" for _ in range(n)]
    shared = [draw(n) for n in (34, 35, 36, 50, 69, 70, 120)]
    texts = []
    for _ in range(120):
        body = draw(r.randint(0, 200))
        for _ in range(r.randint(0, 3)):
            passage = list(r.choice(shared))
            if r.random() < 0.4:
                passage[r.randrange(len(passage))] = "edited"
            at = r.randint(0, len(body))
            body[at:at] = passage
        texts.append(r.choice([" ", "  ", "\n", "\t \r\n"]).join(body))
    texts += [None, "", " \n", "a " * 300, "b " * 35, "c " * 34, "d " * 36, " ".join(draw(34)), " ".join(shared[1]).upper()]
    texts += [" ".join(shared[1]), "é " + " ".join(shared[6]) + " \x85\xa0", "x y z " * 40_000 + " ".join(draw(5000, 10**9))]
    return texts + texts[:6]


@pytest.mark.parametrize("seed, hot", [(1, 500), (2, 2)])
def test_against_counts_of_all_windows(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 20_000)
    texts = corpus(random.Random(seed))
    ids = [i if i % 9 else None for i in range(len(texts))]
    rows = [(i, t, 1, "x") for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int, `n.n` string")
    got = repeats.without_repeats(spark, docs).collect()
    want = [(i, *row) for i, row in zip(ids, plain(texts, repeats.WINDOW))]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert sum(x[2] for x in want) > 5000


def test_a_passage_with_very_many_contexts(spark):
    """Every document holds one passage between words of its own, a third of them twice."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for i in range(1500):
        own = [f"o{i}_{k}" for k in range(r.randint(40, 60))]
        texts.append(" ".join(own[:20] + passage + own[20:] + (passage if i % 3 == 0 else [])))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in repeats.without_repeats(spark, docs).collect()}
    assert got == dict(enumerate(plain(texts, 35)))


def test_short_windows_and_an_empty_table(spark):
    texts = ["a b c d a b c", "x a b c", "q r", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, repeats.without_repeats(spark, docs, window=3).collect()))
    assert got == [(i, *row) for i, row in enumerate(plain(texts, 3))]
    assert repeats.without_repeats(spark, docs.where("false")).isEmpty()


def test_automaton_counts_every_window():
    r = random.Random(3)
    for _ in range(60):
        window = r.randint(1, 5)
        texts = [([r.choice("abc") for _ in range(r.randint(0, 14))], r.randint(1, 3)) for _ in range(r.randint(1, 6))]
        automaton = SuffixAutomaton(window)
        counts = Counter()
        for words, weight in texts:
            automaton.add(words, weight)
            for i in range(len(words) - window + 1):
                counts[tuple(words[i : i + window])] += weight
        automaton.settle()
        known = {tuple(w[i:j]) for w, _ in texts for i in range(len(w)) for j in range(i, len(w) + 1)}
        other = [r.choice("abcd") for _ in range(40)]
        for i, (matched, count) in enumerate(automaton.statistics(other)):
            lengths = [n for n in range(1, window + 1) if n <= i + 1 and tuple(other[i + 1 - n : i + 1]) in known]
            assert matched == max(lengths, default=0)
            assert count == (counts[tuple(other[i + 1 - window : i + 1])] if matched == window else 0)
