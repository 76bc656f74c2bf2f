from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from changeledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; arrays and structs become tuples."""

    def plain(value):
        if isinstance(value, (list, tuple)):
            return tuple(plain(v) for v in value)
        return value

    def collect(df):
        return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)

    return collect
