"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

from strata.plans import ORACLES, QUERIES
from tests.conftest import SF
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees(spark, con, key):
    assert compare(spark, con, key, SF) == []


def test_only_queries_sql_cannot_ask_lack_an_oracle():
    # Each of these is tested against brute force or for its recall in tests/test_vectors.py.
    assert set(QUERIES) - set(ORACLES) == {"vector_search_ann", "embed_batch", "semantic_search"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 5
