from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from check_queries import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Collected rows as tuples, sorted."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return collect
