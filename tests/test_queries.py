"""Every registered query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as contract
from tests.oracle import duck, mismatch
from twinledger.queries import load

QUERIES, ORACLES = load()
# Too few rows at the smallest scale for these reports to show anything.
MAY_BE_EMPTY = {"replacement_char_count", "errors_recent"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf, con, name):
    problem = mismatch(con, QUERIES[name](spark, sf), ORACLES[name])
    assert problem is None or (problem == "empty result" and name in MAY_BE_EMPTY), problem


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(ORACLES) == set(QUERIES)
    df = contract.entry(spark)
    assert df.columns == ["o_orderkey", "diff_type"] and df.count() > 0
