"""Every registered query against its SQL counterpart in DuckDB."""

import compare
import pytest

import __spark_entry__ as contract
from tillflow import registry

FOLDER = "/root/testdata/sf0.01"
#: Every part of the supplied tables is sold.
EMPTY = {"sql11_products_never_sold"}

QUERIES, SQL = registry.QUERIES, contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    names, rows = compare.spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = compare.duck_rows(duck, SQL[name])
    assert names == expected_names
    assert expected or name in EMPTY, "an empty result proves nothing"
    assert rows == expected


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["item_id", "total_revenue"]
    assert result.count() > 0
