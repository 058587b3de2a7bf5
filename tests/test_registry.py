import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from basketry.plans.registry import QUERIES
from check_oracle import compare, connect
from oracle_queries import ORACLE_SQL

DATA = os.environ.get("BASKETRY_DATA_DIR", "/root/testdata/sf0.001")
NO_SQL = {"cohort_retention_approx", "preview_orders"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no sample tables")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == NO_SQL
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_flagship_query(spark):
    assert entry(spark).count() == 13


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, DATA, name) is None
