"""White-space chunks of a text, encoded once each and joined.

No token of a word vocabulary spans white space, so a text's ids are those of its chunks in
order. A worker keeps what it has encoded, up to a bound in bytes; what was used lately stays.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

KEPT_BYTES = 96 << 20  # that the chunks a worker remembers may take, and again their words
ENTRY_BYTES = 200  # of an entry beside its characters: two objects and a place in a table
GROUP = 1 << 20  # characters that are split at once

#: The characters that the vocabulary's splitting pattern counts as white space.
SPACE = r"\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[^{SPACE}]+")
#: str.split() takes these for white space as well.
_CONTROLS = re.compile("[\x1c-\x1f]")


def chunks_of(text: str) -> list[str]:
    return _RUNS.findall(text) if _CONTROLS.search(text) else text.split()


#: A chunk of letters alone and ASCII signs after it is cut there by the splitting pattern too.
SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


def _stays_letters(word: str) -> bool:
    """Whether no mark appears at the end of a word in normal form and lower case."""
    return unicodedata.is_normalized("NFC", word) and word.lower().isalpha()


class Recent:
    """Keys and bytes in two tables; when the younger is full it replaces the older.

    Each holds at most half of ``limit`` and one group's entries; what is asked for again
    moves to the younger one.
    """

    def __init__(self, limit: int) -> None:
        self.half = limit // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def missing(self, *groups: Iterable[str]) -> set[str]:
        """The keys of all groups that are not held; all others are in ``young`` until the next call."""
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        rest: set[str] = set()
        for keys in groups:  # most keys are held, so only the others enter a set
            rest.update(filterfalse(self.young.__contains__, keys))
        if rest and self.old:
            again = {k: value for k in rest if (value := self.old.get(k)) is not None}
            self.put(again)
            rest.difference_update(again)
        return rest

    def put(self, entries: dict[str, bytes]) -> None:
        self.young.update(entries)
        self.size += sum(map(len, entries)) + sum(map(len, entries.values())) + ENTRY_BYTES * len(entries)


_BLANK = re.compile(f"[{SPACE}]")


def _pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of about ``GROUP`` characters, cut at white space."""
    at = 0
    while len(text) - at > GROUP:
        blank = _BLANK.search(text, at + GROUP)
        if blank is None:
            break
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:]


class ChunkStore:
    """Ids of chunks as bytes; ``encode`` makes those of many new ones at once.

    A word with signs behind it is stored as the word and the signs, so that one form of a
    word serves wherever it stands in a sentence.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = KEPT_BYTES) -> None:
        self.encode = encode
        self.known = Recent(limit)
        self.parts = Recent(limit)

    def of_texts(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of every text in order; null counts as empty."""
        group: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if size + len(text) > GROUP:
                yield from self._of_group(group)
                group, size = [], 0
            if len(text) > GROUP:
                yield b"".join(ids for piece in _pieces(text) for ids in self._of_group([piece]))
            else:
                group.append(text)
                size += len(text)
        yield from self._of_group(group)

    def _of_group(self, texts: list[str]) -> list[bytes]:
        split = [chunks_of(t) for t in texts]
        if missing := self.known.missing(*split):
            self.known.put(self._learn(missing))
        get = self.known.young.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        words: dict[str, str] = {}  # of each chunk the form that is encoded, without the signs behind it
        signs: dict[str, str] = {}
        for chunk in chunks:
            word = chunk if chunk.isalpha() else chunk.rstrip(SIGNS)
            plain = word.isascii()
            if not word.isalpha() or not (plain or len(word) == len(chunk) or _stays_letters(word)):
                words[chunk] = chunk
                continue
            words[chunk] = word.lower() if plain else word
            if len(word) < len(chunk):
                signs[chunk] = chunk[len(word) :]
        if missing := self.parts.missing(words.values(), signs.values()):
            names = list(missing)
            self.parts.put(dict(zip(names, self.encode(names))))
        get = self.parts.young.__getitem__
        known = dict(zip(words, map(get, words.values())))
        for chunk, end in signs.items():
            known[chunk] += get(end)
        return known
