"""Every registered query next to its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from goldweave.checks import QUERIES, SQL
from compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    _, rows, verdict = compare(
        spark, connection, FOLDER, name, QUERIES[name], SQL.get(name)
    )
    assert verdict == "ok"


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
