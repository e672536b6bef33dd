"""Suffix automata of word sequences, with weighted counts of the windows that end in a state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class SuffixAutomaton:
    """All substrings of the sequences added to it.

    ``add`` counts, with the sequence's weight, every position at which a window of ``window``
    words ends; ``settle`` sums the counts of longer contexts into those of their suffixes.
    """

    def __init__(self, window: int) -> None:
        self.window = window
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _target(self, p: int, word: object) -> int:
        """The state of p's longest string followed by ``word``; splits one that is longer."""
        following, link, length = self.next, self.link, self.length
        q = following[p][word]
        if length[q] == length[p] + 1:
            return q
        copy = self._state(length[p] + 1, dict(following[q]), link[q])
        link[q] = copy
        while p >= 0 and following[p].get(word) == q:
            following[p][word] = copy
            p = link[p]
        return copy

    def add(self, words: Sequence, weight: int) -> None:
        following, link, length, count = self.next, self.link, self.length, self.count
        last, first_end = 0, self.window - 1
        for i, word in enumerate(words):
            if word in following[last]:
                last = self._target(last, word)
            else:
                new, p = self._state(length[last] + 1, {}, 0), last
                while p >= 0 and word not in following[p]:
                    following[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._target(p, word)
                last = new
            if i >= first_end:
                count[last] += weight

    def settle(self) -> None:
        count, link = self.count, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if link[state] > 0:
                count[link[state]] += count[state]

    def statistics(self, words: Iterable) -> Iterator[tuple[int, int]]:
        """For every word the length of the longest match that ends there, up to the window,
        and the count of the matched window (0 for a shorter match)."""
        following, link, length, count, window = self.next, self.link, self.length, self.count, self.window
        state = matched = 0
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            state = following[state].get(word, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= window:
                state = link[state]
            if matched >= window:
                matched = window
                yield matched, count[state]
            else:
                yield matched, 0
