"""The test of near pairs by their longer signatures, cell by cell."""

from __future__ import annotations

import random

import pyarrow as pa

from ledgerwide.llm import near_dedup as nd
from ledgerwide.llm.words import shingle_set, split_words


def test_cells_refuse_far_pairs_and_keep_near_ones(spark):
    r = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(12):
        words = list(base)
        for _ in range(1 + 12 * (k % 3)):
            words[r.randrange(300)] = f"x{r.random()}"
        texts.append(" ".join(words))
    split = split_words(pa.array(texts))
    sets = [shingle_set(split.row(i), 3) for i in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sizes = spark.createDataFrame([(i, len(s)) for i, s in enumerate(sets)], "node long, n_shingles long")
    signs = sizes.join(nd.fine_signatures(frame, 3), "node")
    pairs = [(a, b) for a in range(12) for b in range(a + 1, 12)]

    def alike(a, b):
        x, y = set(sets[a].tolist()), set(sets[b].tolist())
        return len(x & y) / len(x | y)

    for blocks in (1, 5):
        found = nd._fine_pairs(spark.createDataFrame(pairs, "a long, b long"), signs, blocks, 0.85)
        kept = {tuple(row) for row in found.collect()}
        assert {p for p in pairs if alike(*p) >= 0.85} <= kept
        assert not {p for p in pairs if alike(*p) < 0.6} & kept
