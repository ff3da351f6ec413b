"""Every registered query against its SQL on the smallest tables."""

import pytest
from comparing import DATA, connect, duckdb_rows, spark_rows

from tallyhouse.plans.catalog import EXPECTED, QUERIES

FOLDER = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == duckdb_rows(con, EXPECTED[name])


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() == 10
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())
