"""Tree matching against an exhaustive search, and pages that are very deep or long."""

from __future__ import annotations

import random
import time
from functools import cache

import pytest

from ledgerwide.llm import html_text, trees


def random_tree(r, size):
    depths, labels = [0], ["r"]
    for _ in range(r.randint(0, size)):
        depths.append(r.randint(1, depths[-1] + 1))
        labels.append(r.choice("xyz"))
    return trees.Tree(depths, labels)


def largest(a, b):
    """Size of the largest matching by plain recursion over all alignments."""

    @cache
    def pair(x, y):
        if a.labels[x] != b.labels[y]:
            return 0
        return 1 + forest(tuple(a.children[x]), tuple(b.children[y]))

    @cache
    def forest(left, right):
        if not left or not right:
            return 0
        return max(forest(left[1:], right), forest(left, right[1:]), pair(left[0], right[0]) + forest(left[1:], right[1:]))

    return pair(0, 0)


@pytest.mark.parametrize("cells", [1 << 22, 4])
def test_matching_is_the_largest_and_keeps_order_and_parents(monkeypatch, cells):
    monkeypatch.setattr(trees, "GRID_CELLS", cells)
    r = random.Random(8)
    for _ in range(300):
        a, b = random_tree(r, 14), random_tree(r, 14)
        pairs = trees.Matcher(a, b).pairs()
        assert len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs}) == largest(a, b)
        to = dict(pairs)
        for x, y in pairs:
            assert a.labels[x] == b.labels[y] and (x == 0) == (y == 0)
            if x:
                assert to[a.parent[x]] == b.parent[y]
        ordered = sorted(pairs)
        assert [y for _, y in ordered] == sorted(y for _, y in pairs)


def test_deep_and_long_pages(spark):
    deep = "<html><body><article>" + "<div>" * 100_000 + "at the bottom" + "</div>" * 99_000
    blocks = [f"<h2>head {k}</h2><p>paragraph {k}</p>" if k % 7 else f"<p>lone {k}</p><ul><li>x{k}</ul>" for k in range(6000)]
    rows = [(1, "http://a/1", deep), (2, "http://a/2", deep.replace("<div>", "<section>", 50_000))]
    rows += [(k, f"http://b/{k}", "<article>" + "".join(blocks[k * 40 :]) + "</article>") for k in range(3, 6)]
    rows += [(6, "http://a/3", "<p>" + "<b>x</b> " * 50_000), (7, "http://a/4", "<td>" * 20_000 + "</p>" * 20_000)]
    started = time.time()
    got = {x.page_id: x.text for x in html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert time.time() - started < 120
    assert got[1] == got[2] == "at the bottom"
    assert got[4].startswith("head 160 paragraph 160") and got[4].count("paragraph") == sum(1 for k in range(160, 6000) if k % 7)
