import os

import pytest

import __spark_entry__
from orderpulse.queries import ORACLES, QUERIES
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    """Packages beside this one may add queries, and SQL only for those."""
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys() and ORACLES.keys() <= __spark_entry__.oracle_sql().keys()
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_entry(spark):
    assert [r.industry for r in __spark_entry__.entry(spark).collect()] == ["MACHINERY"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None
