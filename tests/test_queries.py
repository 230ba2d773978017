import pytest

import __spark_entry__ as e
from acequia import registry
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    assert e.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(e.queries()[name](spark, ROOT), con, e.oracle_sql()[name]) is None
