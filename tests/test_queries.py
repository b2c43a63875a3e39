"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from tests.oracle import compare, connect
from touchpoint.catalog import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, queries()[name], oracle_sql()[name])
    assert ok, note
