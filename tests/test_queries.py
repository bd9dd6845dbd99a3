import os

import pytest

import __spark_entry__ as entry
from compare import check, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query_agrees_with_sql(spark, con, name):
    problem, _, _, _ = check(spark, con, name, SF_DIR)
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_orderkey", "entity_id", "closing_date", "total_assets"]
