from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerwide.session import local_session  # noqa: E402
from ledgerwide.sources.literal import literal_table  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Small hand-made frames: rows(schema, *tuples)."""

    def make(schema: str, *values: tuple):
        return literal_table(spark, list(values), schema)

    return make
