"""Every registered query against its SQL, on the smallest supplied tables."""

import os

import pytest

from suite.compare import difference, duck
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not found")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry_is_batch_sessions(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert "batch_session_id" in entry(spark).columns
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())
