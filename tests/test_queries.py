import pytest

import __spark_entry__ as driver
from tests.oracle_check import check, connect

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_names():
    assert set(SQL) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 2


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name):
    what, wrong, _ = check(spark, con, name, driver.queries()[name], SQL[name], sf)
    assert wrong is None
    assert "types" not in what
