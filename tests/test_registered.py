"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences
from tidelog.plans.catalog import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TEXTS = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to run on")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(TEXTS) & set(REGISTRY)))
def test_query_equals_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, TEXTS[name]) == []


def test_queries_without_sql_run(spark):
    assert set(REGISTRY) - set(TEXTS) == {"feed_timeline"}
    assert QUERIES["feed_timeline"](spark, SF_DIR).count() > 0


def test_flagship_query_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
