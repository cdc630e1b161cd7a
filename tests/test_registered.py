"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from registry.oracles import ORACLES
from registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "accepted" in df.columns


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, sql) is None
