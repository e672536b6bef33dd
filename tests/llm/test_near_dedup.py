"""Near-duplicates, components and words against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerwide.llm import near_dedup as nd
from ledgerwide.llm.components import connected_components
from ledgerwide.llm.words import shingle_set, split_words

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = re.findall(WORD, lower(text))
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def brute(rows, size, percent):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = sets_of(rows, size)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed=3):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(12):
        base = [r.choice(words) for _ in range(r.randint(3, 120))]
        for copy in range(r.randint(1, 8)):
            new = list(base)
            for _ in range(r.randint(0, 4)):
                new[r.randrange(len(new))] = r.choice(words)
            rows.append((len(rows), " ".join(new).upper() if copy % 2 else "\t".join(new)))
    return rows + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "ONE"), (905, "one two")]


@pytest.mark.parametrize("size,similarity", [(3, 0.85), (5, 0.8)])
def test_components_match_all_pairs(spark, size, similarity):
    rows = near_copies()
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, kept int, cls int")
    got = nd.near_duplicates(spark, docs, size, similarity).drop("cls").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, size, round(100 * similarity))


def test_repeated_rows_nulls_and_long_texts(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "q r s t"), (2, long), (1, long + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(spark, docs, 3, 0.85).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [
        ("1", 1), ("2", 1), ("5", 5), ("5", 5), ("7", 7), ("None", 5)
    ]
    kept = nd.keep_one(spark, docs, 3, 0.85).collect()
    assert sorted(r.doc_id for r in kept) == [1, 5, 7]


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(5, a), (5, b), (2, b + " more"), (None, c), (None, c + " more"), (None, d), (None, a + " more"), (8, a), (8, d + " x")]
    rows += [(None, ""), (None, None), (9, " "), (9, "\n")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, cls int")
    kept = nd.keep_one(spark, docs, 3, 0.85)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(5, a), (2, b + " more"), (None, c), (8, d + " x"), *rows[-4:]], key=str)
    assert nd.keep_one(spark, docs.limit(0), 3, 0.85).isEmpty()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(spark, docs).collect() == []


def test_distance_is_counted_by_place(spark):
    r = random.Random(1)
    rows = []
    for _ in range(50):
        a = [r.randrange(4) for _ in range(10)]
        b = [r.randrange(4) for _ in range(10)]
        pack = lambda v: sum(x << (12 * k) for k, x in enumerate(v))
        rows.append((pack(a[:5]), pack(b[:5]), sum(x != y for x, y in zip(a[:5], b[:5]))))
    frame = spark.createDataFrame(rows, "x long, y long, want int")
    assert frame.where(nd.differences("x", "y") != frame["want"]).isEmpty()


def test_layout_bounds_the_miss():
    assert nd.layout(0.85) < nd.layout(0.8)
    rng = np.random.default_rng(5)
    pairs = rng.random((20_000, 5 * nd.layout(0.85))) > 0.85
    assert (pairs.sum(axis=1) <= 2 * nd.layout(0.85) - 1).mean() > 0.999


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: 1 for n in range(1, 41)} | {n: 100 for n in range(100, 140)}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_follow_the_pattern():
    texts = ["A b\tc\n\nd", "", None, "é x y", " lead and trail ", "same same", "x" * 3_000_000 + " y"]
    found = split_words(pa.array(texts))
    for r, text in enumerate(texts):
        want = re.findall(WORD, lower(text))
        assert len(found.row(r)) == len(want)
    assert found.row(5)[0] == found.row(5)[1]
    assert len(shingle_set(found.row(0), 3)) == 2


def test_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(8)
    for size, changed in [(1, 1), (40, 3), (600, 60), (9_000, 800)]:
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        b = np.concatenate([a[changed:], rng.integers(0, 2**64, changed // 2, dtype=np.uint64)])
        apart = int(np.bitwise_count((nd.parity(a) ^ nd.parity(b)).view(np.uint64)).sum())
        assert apart <= changed + changed // 2
        if size < 1_000:
            assert apart >= 0.9 * (changed + changed // 2)


def around(center, n, most, seed, words):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        new = list(center)
        for _ in range(r.randint(0, most)):
            new[r.randrange(len(new))] = r.choice(words) if r.random() < 0.5 else f"u{r.random()}"
        out.append(" ".join(new))
    return out


@pytest.mark.parametrize("size,similarity,listed", [(3, 0.85, 32), (5, 0.8, 0)])
def test_many_near_texts_without_links_make_no_list_of_pairs(spark, monkeypatch, size, similarity, listed):
    words = [f"w{k}" for k in range(500)]
    r = random.Random(9)
    one = [r.choice(words) for _ in range(150)]
    two = one[:120] + [f"z{k}" for k in range(30)]  # near the first without being linked
    texts = around(one, 260, 22, 1, words) + around(two, 120, 20, 2, words) + [t for _, t in near_copies(5) if t]
    # A text and two longer ones: their differences from it need to share nothing.
    texts += [" ".join(one), " ".join(one + [f"l{k}" for k in range(9)]), " ".join([f"k{k}" for k in range(9)] + one)]
    rows = list(enumerate(texts))
    made = {}
    keep = nd.stored

    def counted(spark, frame, label):
        table = keep(spark, frame, label)
        made.setdefault(label, []).append(table.count())
        return table

    monkeypatch.setattr(nd, "stored", counted)
    monkeypatch.setattr(nd, "LISTED", listed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(spark, docs, size, similarity).drop("cls").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, size, round(100 * similarity))
    assert sum(made["dense"]) > 0
    assert sum(made.get("pairs", [])) < 32 * len(rows) / 4


def test_pairs_by_center_hold_every_link(spark):
    r = random.Random(4)
    base = r.sample(range(10_000), 60)
    sets = [set(base)]
    for _ in range(90):
        gone, new = r.sample(base, r.randint(0, 12)), [r.randrange(60, 90) + 20_000 for _ in range(r.randint(0, 12))]
        sets.append(set(base) - set(gone) | set(new))
    for center in (0, 7):
        rows = []
        for k, s in enumerate(sets):
            apart = sorted(s ^ sets[center])
            rows.append((0, k, k * (k > 9), len(apart), 185 * len(apart) - 15 * len(s), apart))
        frame = spark.createDataFrame(rows, "main long, node long, root long, gap long, score long, apart array<long>")
        got = {(x.a, x.b) for x in nd._sharing(spark, frame, 0.85, []).collect()}
        root = {row[1]: row[2] for row in rows}
        alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
        # Components after the pairs that are links are the same as after all links.
        def parts(pairs):
            top = dict(root)
            for a, b in pairs:
                low, high = sorted((top[a], top[b]))
                top = {n: low if t == high else t for n, t in top.items()}
            return top

        every = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if root[a] != root[b] and alike(a, b)]
        assert every and parts([p for p in got if alike(*p)]) == parts(every)
