"""Bit filters: which 64-bit hashes may be in a set, in a field of fixed size.

A field has 2 ** bits bits whatever the number of hashes, so broadcasting it is bounded. A hash
outside the set passes by chance, the oftener the fuller the field; one inside always passes.
So a field spares work and never decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_of(frame: DataFrame, column: str, bits: int) -> np.ndarray:
    """The field of a long column; it is gathered as words of 64 bits, 2 ** (bits - 6) at most."""
    at = F.shiftright(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)), 6)
    bit = F.expr(f"shiftleft(1L, CAST(({column} & 63) AS INT))")
    found = frame.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("word")).toArrow()
    field = np.zeros(1 << (bits - 6), np.uint64)
    field[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return field


def held(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes may be in the set."""
    low = hashes & np.uint64(64 * len(field) - 1)
    return (field[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def packed(field: np.ndarray) -> tuple[int, np.ndarray | None, np.ndarray]:
    """A field as it is broadcast: only its words that are not zero, while those are few."""
    at = np.flatnonzero(field)
    if 2 * len(at) < len(field):
        return len(field), at.astype(np.int32), field[at]
    return len(field), None, field


def opened(value: tuple[int, np.ndarray | None, np.ndarray]) -> np.ndarray:
    words, at, held_words = value
    if at is None:
        return held_words
    field = np.zeros(words, np.uint64)
    field[at] = held_words
    return field
