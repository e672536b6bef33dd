"""Words, shingles and their hashes over whole Arrow text columns, in numpy.

Words are runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the same as runs
of such code points. A word's hash is a polynomial in its bytes modulo 2**64, taken from
running sums, so a column costs a few array passes and no step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # bytes hashed at once: bounds the arrays of eight bytes a byte

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = _LOWER.copy()  # punctuation becomes a space
_PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
_BYTE = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, made as long as a slice needs."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            one = np.ones(1, np.uint64)
            self.up = np.concatenate([one, np.cumprod(np.full(n, _BASE, np.uint64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n, _INVERSE, np.uint64))])
        return self.up, self.down


_powers = _Powers()


@dataclass
class Words:
    """Words of a text column: byte bounds and hash of each, and the first word of each row."""

    data: np.ndarray  # bytes of the column in lower case
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # rows + 1 positions: row r has words first[r]:first[r + 1]

    def row(self, r: int) -> np.ndarray:
        return self.hashes[self.first[r] : self.first[r + 1]]


def split_words(column: pa.Array, plain: bool = False, cased: bool = False) -> Words:
    """Words of every text of ``column``, A-Z in lower case; null texts have none.

    ``plain`` also takes ASCII punctuation for white space, ``cased`` leaves words unchanged.
    """
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not cased:
        data = (_PLAIN if plain else _LOWER)[data]
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:-1]
    closes[:-1] &= ~inside[1:] | cut[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, begin, end, _hash(data, begin, end), np.searchsorted(begin, offsets))


def _hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + SLICE_BYTES, "right")))
        lo, hi = begin[i], end[j - 1]
        up, down = _powers.to(int(hi - lo))
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = begin[i:j] - lo, end[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _MIX[0]
        i = j
    return mix(out)


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` words of one row, in order; none if it is shorter."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(_BASE) + hashes[k : k + n])
    return total


def run_hashes(hashes: np.ndarray, begin: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Hash of the ``size`` words from every position of ``begin``, by running sums."""
    up, down = _powers.to(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    sums = (total[begin + size] - total[begin]) * down[begin]
    return mix(sums + np.uint64(_BASE) * np.asarray(size, np.uint64))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one row; a shorter row is one shingle, an empty one none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(ngrams(hashes, min(size, len(hashes))))


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that arrays beside a batch stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


PIECE_BYTES = 1 << 22
_BLANKS = b" \t\n\r\x0b\x0c"


def word_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut at white space: no word is divided.

    A text of one endless word is one piece. The white space is what bytes.split() takes.
    """
    at = 0
    while len(text) - at > size:
        ends = [e for e in (text.find(b, at + size) for b in (bytes([x]) for x in _BLANKS)) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:] if at else text
