"""Every registered query gives the same rows as its SQL."""

import pytest

from conftest import SF_DIR
from registry.check import compare, connect
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["product_category", "net_sales", "average_order_value"]
    assert df.count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
