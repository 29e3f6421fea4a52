"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck
from checks.registry import ORACLES, QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "rank" and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
