"""Bit fields: what is inside always passes."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerwide.llm import bits


@pytest.mark.parametrize("size", [0, 5, 3000])
def test_members_pass_and_few_others(spark, size):
    random = np.random.default_rng(1)
    inside, outside = (random.integers(-(2**63), 2**63, n) for n in (size, 2000))
    frame = spark.createDataFrame([(int(x),) for x in inside], "h long")
    field = bits.opened(bits.packed(bits.field_of(frame, "h", 16)))
    assert len(field) == 1 << 10
    assert bits.held(field, inside.view(np.uint64)).all()
    assert bits.held(field, outside.view(np.uint64)).mean() <= size / 2**16 + 0.02
    full = np.full(1 << 10, 2**64 - 1, np.uint64)
    assert (bits.opened(bits.packed(full)) == full).all()
