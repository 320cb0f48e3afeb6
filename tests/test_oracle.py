"""Every query of the library against its SQL twin."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from opsframe.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
# Queries whose result on these small tables is empty by right.
EMPTY = {"query_by_pk", "active_tables", "source_tables", "dict_filter", "key_eq"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    problems = compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert [p for p in problems if p != "no rows" or name not in EMPTY] == []


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
