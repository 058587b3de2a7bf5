import os

import pytest

from __spark_entry__ import LLM_QUERIES
from check_oracle import compare, connect

DATA = os.environ.get("BASKETRY_DATA_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no sample tables")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_query_equals_sql_or_has_rows(spark, connection, name):
    assert compare(spark, connection, DATA, name) is None
