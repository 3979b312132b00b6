"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from millrace.plans.registry import ORACLES as SQL
from millrace.plans.registry import QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    ok, message = compare(spark, con, name, QUERIES[name], SQL.get(name), folder)
    assert ok, message


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the small tables")
def test_entry(spark):
    assert entry(spark).count() > 0
