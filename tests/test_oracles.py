"""Every named query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from tripflow.registry.oracles import ORACLES
from tripflow.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None


def test_every_query_has_sql_and_every_sql_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
