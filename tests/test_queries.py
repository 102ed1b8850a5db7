"""Every registered query against its SQL twin, and the driver contract."""

import pytest
from check_oracle import compare, oracle_connection

import __spark_entry__ as driver

QUERIES, SQL = driver.QUERIES, driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    with oracle_connection(sf_dir) as connection:
        yield connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, QUERIES[name], SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(driver.queries()) and set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


