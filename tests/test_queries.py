"""Every registered catalogue query with SQL gives the rows of its SQL on the small tables."""

import pytest
from compare import connect, differ

from quire.plans import queries as plans

SMALL = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differ(plans.queries()[name](spark, SMALL), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_runs(spark, name):
    plans.queries()[name](spark, SMALL).collect()


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(plans.queries()) <= set(driver.queries())
