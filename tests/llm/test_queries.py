"""Every query of the subpackage against its SQL, and the shape of the others' results."""

from __future__ import annotations

import pytest

from casecurve.llm.queries import ORACLES, QUERIES
from oracle import compare, connect


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, small, duck):
    assert compare(QUERIES[name](spark, small), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_a_row_per_document(name, spark, small):
    rows = QUERIES[name](spark, small)
    assert rows.count() >= 200
