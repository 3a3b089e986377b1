"""Every registered query against its SQL on the small tables."""

import pytest
from compare import connect, differences
from conftest import SMALL

from testbed.oracle import all_oracles
from testbed.queries import all_queries


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_sql(spark, database, name):
    assert differences(all_queries()[name](spark, SMALL), database, all_oracles()[name]) == []


def test_flagship_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(all_queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
