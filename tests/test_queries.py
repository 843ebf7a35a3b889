"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLE[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["SalesTimestamp", "TotalSales"]
    assert df.count() > 0
