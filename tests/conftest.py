"""One local session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.cluster import clear_scratch  # noqa: E402
from tests.oracle import session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = session("4")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-"))
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture
def sf() -> str:
    return SF


@pytest.fixture
def path(tmp_path) -> str:
    return str(tmp_path / "t")


def rows(df, *columns):
    """Rows as sorted tuples."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, str(type(v)), v) if not isinstance(v, (list, dict))
                                           else (True, "", str(v)) for v in t))
