import pytest

import __spark_entry__ as driver
from checks.oracles import ORACLES
from checks.registry import QUERIES
from compare import database, difference
from conftest import SF_DIR


@pytest.fixture(scope="module")
def tables():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_against_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) is None


def test_entry(spark, tables):
    held_out = "SELECT count(*) FROM lineitem WHERE l_orderkey % 10 >= 8"
    assert driver.entry(spark).count() == tables.execute(held_out).fetchone()[0]
