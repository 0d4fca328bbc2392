"""Every query against its SQL, and the entry point."""

import pytest

import __spark_entry__ as entry_point
from aisleflow.catalog import QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    result = entry_point.queries()[name](spark, SF)
    assert differences(result, con, entry_point.oracle_sql()[name]) == []


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == [
        "orgId", "storeId", "day", "month", "year", "time", "categoryId", "converted", "failed", "total"
    ]
    assert result.count() > 0
