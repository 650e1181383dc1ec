"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(result, con, ORACLES[name]) is None
    else:
        assert result.columns and result.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
