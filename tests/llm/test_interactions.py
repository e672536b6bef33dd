"""Filter interactions against a replay of every order over every document."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pytest

from ledgerwide.llm import interactions, words


def fails(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(ws) < 100,
        "B": 100 * len(set(ws)) < 80 * len(ws),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
    }


def replayed(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    by_part = {}
    for i, text, lang in docs:
        text = text or ""
        bad = fails(text)
        bad["E"] = i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs)
        by_part.setdefault(lang or "", []).append((i, bad))
    rows = {}
    for part, members in by_part.items():
        shares = Counter()
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[1][f]]
                left = [m for m in left if not m[1][f]]
                shares[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(m[1][f] for m in members) - len(gone),
                    sum(m[1][f] and sum(m[1].values()) == 1 for m in members),
                    sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone),
                ]
        for key in [k for k in rows if k[0] == part]:
            rows[key].append(shares[key[1][key[2] - 1]])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_replay_of_all_orders(spark, seed):
    r = random.Random(seed)
    words_of = lambda n, k: " ".join(r.choice("abcdefgh") + str(r.randint(0, k)) for _ in range(n))
    texts = [words_of(r.choice([20, 99, 100, 101, 150]), r.choice([3, 500])) for _ in range(30)]
    texts += [None, "", " ", "A" * 12 + "b" * 90, "é" * 100, "A" * 10 + "é" * 90, "A" * 11 + "é" * 89, "x # y", "a|b", "\x85 \xa0"]
    texts += ["long word " * 60_000 + "end"]
    docs = [(r.randint(0, 60) if r.random() < 0.9 else None, r.choice(texts), r.choice(["en", "fr", None, ""])) for _ in range(150)]
    docs += docs[:5]
    labels = [(r.randint(0, 60) if r.random() < 0.9 else None, r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(80)]
    d = spark.createDataFrame([(*x, 7) for x in docs], "doc_id long, text string, lang string, `mask` int")
    known = spark.createDataFrame([(*x, "n") for x in labels], "doc_id long, quality int, toxic int, n string")
    got = interactions.interactions(spark, d, known).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = replayed(docs, labels)
    assert {(x.part, x.filter_order, x.step): [x[n] for n in names] for x in got} == want and len(got) == len(want)


def test_shapley_coefficients_equal_the_marginal_definition():
    n = 5
    for i, row in enumerate(interactions.shapley_coefficients()):
        want = [Fraction(0)] * 32
        rest = [j for j in range(n) if j != i]
        for size in range(n):
            for others in combinations(rest, size):
                s = sum(1 << j for j in others)
                weight = Fraction(factorial(size) * factorial(n - 1 - size))
                want[s | 1 << i] += weight
                want[s] -= weight
        assert row[1:] == want[1:]  # the removal of no filter is 0, so its weight counts for nothing


def test_empty_tables_and_no_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.interactions(spark, docs, labels).isEmpty()
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    got = interactions.interactions(spark, one, labels).collect()
    assert len(got) == 600 and {(x.part, x.good_lost, x.toxic_lost) for x in got} == {("", 0, 0)}
    assert sum(x.removed for x in got) == 120 and {x.shapley for x in got} == {0, 120}


def test_pieces_divide_no_word():
    text = b"ab  cd\nefg " * 1000
    for size in (1, 7, 100):
        pieces = list(words.word_pieces(text, size))
        assert b"".join(pieces) == text and [w for p in pieces for w in p.split()] == text.split()
    assert list(words.word_pieces(b"x" * 50, 10)) == [b"x" * 50] and list(words.word_pieces(b"")) == [b""]
