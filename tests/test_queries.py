"""Every registered query against its SQL on the small tables."""

import __spark_entry__ as entry_module
import pytest
from compare import connect, differences

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.columns[0] == "hour" and rows.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    found = differences(QUERIES[name](spark, SMALL), con, ORACLES[name])
    # the smallest tables can leave a filter without rows; equality still has to hold
    assert [f for f in found if f != "no rows"] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
