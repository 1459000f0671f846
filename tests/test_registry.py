"""Every checked query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from oracle import compare, duck
from strata.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sql = entry_module.oracle_sql()[name]
    ok, msg = compare(entry_module.queries()[name](spark, SF), con, sql)
    assert ok, msg


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    # Every query of the library itself has its SQL; the optional text
    # operators without one are tested against brute force in tests/llm.
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())
