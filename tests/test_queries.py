"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from check import oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry.__name__ == "entry"


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, name):
    found = spark_rows(driver.queries()[name](spark, SF_DIR))
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert found[1]
    else:
        assert found == oracle_rows(SF_DIR, sql)
