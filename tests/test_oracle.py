"""Every registered query against its SQL over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from skillscope.plans.oracle import ORACLE
from skillscope.plans.queries import REGISTRY as QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_registry():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "skill" and df.count() > 0
