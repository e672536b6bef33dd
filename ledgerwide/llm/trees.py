"""Simple tree matching of labelled, ordered trees of any depth and width.

Trees are flat: nodes in document order with their labels and depths. Equal subtrees get equal
class numbers, which two trees share, so a subtree that both have is matched whole. Children are
aligned as sequences: equal classes at both ends are paired at once, what lies between by
dynamic programming, a row of the grid at a time, in halves where the grid would be large.
Nothing here recurses into the depth of a tree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

GRID_CELLS = 1 << 22  # of an alignment that is traced back directly; larger ones are halved


class Tree:
    """Nodes in document order; ``end`` is one past a node's last descendant."""

    def __init__(self, depths: Sequence[int], labels: Sequence[str]) -> None:
        self.labels = labels
        self.parent: list[int] = []
        self.children: list[list[int]] = [[] for _ in labels]
        self.end = [0] * len(labels)
        open_: list[int] = []
        for k, depth in enumerate(depths):
            while len(open_) > depth:
                self.end[open_.pop()] = k
            self.parent.append(open_[-1] if open_ else -1)
            if open_:
                self.children[open_[-1]].append(k)
            open_.append(k)
        for k in open_:
            self.end[k] = len(labels)


class Matcher:
    """The largest set of node pairs of two trees that keeps labels, order and parents."""

    def __init__(self, a: Tree, b: Tree) -> None:
        self.a, self.b = a, b
        self.members: list[tuple] = []  # of each class: label and classes of the children
        self.sizes: list[int] = []
        self.known: dict[tuple[int, int], int] = {}
        known: dict[tuple, int] = {}
        self.of_a, self.of_b = self._classes(a, known), self._classes(b, known)

    def _classes(self, tree: Tree, known: dict[tuple, int]) -> list[int]:
        found = [0] * len(tree.labels)
        for k in range(len(tree.labels) - 1, -1, -1):
            key = (tree.labels[k], tuple(found[c] for c in tree.children[k]))
            if key not in known:
                known[key] = len(self.members)
                self.members.append(key)
                self.sizes.append(1 + sum(self.sizes[c] for c in key[1]))
            found[k] = known[key]
        return found

    def pairs(self) -> list[tuple[int, int]]:
        """(node of a, node of b), parents before children; none if the roots differ."""
        if self.a.labels[0] != self.b.labels[0]:
            return []
        self._measure(self.of_a[0], self.of_b[0])
        found, waiting = [], [(0, 0)]
        while waiting:
            x, y = waiting.pop()
            found.append((x, y))
            if self.of_a[x] == self.of_b[y]:
                found += zip(range(x + 1, self.a.end[x]), range(y + 1, self.b.end[y]))
                continue
            left, right = self.a.children[x], self.b.children[y]
            for i, j in self._aligned([self.of_a[c] for c in left], [self.of_b[c] for c in right]):
                waiting.append((left[i], right[j]))
        return found

    def _size(self, x: int, y: int) -> int:
        if x == y:
            return self.sizes[x]
        if self.members[x][0] != self.members[y][0]:
            return 0
        return self.known[x, y]

    def _measure(self, x: int, y: int) -> None:
        """Fill in the sizes of the largest matchings of x, y and whatever they rest on."""
        waiting = [(x, y, False)]
        while waiting:
            x, y, ready = waiting.pop()
            if x == y or (x, y) in self.known or self.members[x][0] != self.members[y][0]:
                continue
            left, right = self.members[x][1], self.members[y][1]
            lo, hi = _ends(left, right)
            left, right = left[lo : len(left) - hi], right[lo : len(right) - hi]
            if ready:
                whole = self.members[x][1]
                ends = sum(self.sizes[c] for c in whole[:lo] + whole[len(whole) - hi :])
                self.known[x, y] = 1 + ends + (int(self._last_row(left, right)[-1]) if left and right else 0)
            else:
                waiting.append((x, y, True))
                ours, theirs = dict.fromkeys(left), dict.fromkeys(right)
                waiting += [(c, d, False) for c in ours for d in theirs]

    def _weights(self, x: int, places: np.ndarray, classes: list[int]) -> np.ndarray:
        return np.array([self._size(x, c) for c in classes], np.int64)[places]

    def _rows(self, left: Sequence[int], right: Sequence[int]):
        """Rows of the grid of best sums, the first one zeros."""
        classes = list(dict.fromkeys(right))
        index = {c: k for k, c in enumerate(classes)}
        places = np.array([index[c] for c in right], np.int64)
        weights: dict[int, np.ndarray] = {}
        row = np.zeros(len(right) + 1, np.int64)
        yield row
        for x in left:
            if x not in weights:
                weights[x] = self._weights(x, places, classes)
            best = row.copy()
            np.maximum(best[1:], row[:-1] + weights[x], out=best[1:])
            row = np.maximum.accumulate(best)
            yield row

    def _last_row(self, left: Sequence[int], right: Sequence[int]) -> np.ndarray:
        for row in self._rows(left, right):
            pass
        return row

    def _aligned(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        """Pairs of places of two child lists in a best alignment."""
        found = []
        waiting = [(0, len(left), 0, len(right))]
        while waiting:
            a, b, c, d = waiting.pop()
            lo, hi = _ends(left[a:b], right[c:d])
            found += [(a + k, c + k) for k in range(lo)] + [(b - k, d - k) for k in range(1, hi + 1)]
            a, b, c, d = a + lo, b - hi, c + lo, d - hi
            if a == b or c == d:
                continue
            if b - a > 1 and (b - a + 1) * (d - c + 1) > GRID_CELLS:
                middle = (a + b) // 2
                before = self._last_row(left[a:middle], right[c:d])
                after = self._last_row(left[middle:b][::-1], right[c:d][::-1])[::-1]
                cut = c + int(np.argmax(before + after))
                waiting += [(a, middle, c, cut), (middle, b, cut, d)]
                continue
            grid = list(self._rows(left[a:b], right[c:d]))
            i, j = b - a, d - c
            while i and j:
                own = self._size(left[a + i - 1], right[c + j - 1])
                if own and grid[i][j] == grid[i - 1][j - 1] + own:
                    found.append((a + i - 1, c + j - 1))
                    i, j = i - 1, j - 1
                elif grid[i][j] == grid[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
        return found


def _ends(left: Sequence[int], right: Sequence[int]) -> tuple[int, int]:
    """How many equal classes stand at the beginning and, besides those, at the end.

    Pairing them is never worse: a class can be matched with no more than itself.
    """
    most = min(len(left), len(right))
    lo = 0
    while lo < most and left[lo] == right[lo]:
        lo += 1
    hi = 0
    while hi < most - lo and left[len(left) - 1 - hi] == right[len(right) - 1 - hi]:
        hi += 1
    return lo, hi
