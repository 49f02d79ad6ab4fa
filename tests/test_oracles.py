"""Every registered query against its SQL oracle."""

import os

import __spark_entry__ as driver
import compare
import pytest

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_query_has_an_oracle():
    own = set(driver.queries()) - set(driver.LLM_QUERIES)
    assert own == set(driver.oracle_sql()) - set(driver.LLM_ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, con, name):
    columns, rows = compare.of_spark(driver.queries()[name](spark, SF_DIR))
    expected_columns, expected = compare.of_duck(con, driver.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
