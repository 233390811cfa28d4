"""Every query with a SQL equivalent against DuckDB; the others must run and give rows."""

from __future__ import annotations

import pytest

from casecurve.plans.catalog import ORACLES, QUERIES
from oracle import compare, connect

@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(df, duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(name, spark, small):
    assert QUERIES[name](spark, small).count() > 0


def test_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns[:2] == ["series_id", "ds"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
