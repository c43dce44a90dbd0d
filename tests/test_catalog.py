"""Every registered query gives the rows its SQL gives."""

import pytest

import __spark_entry__ as entry
from compare import DATA, differences, oracle
from drayage.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return oracle()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_holds_the_catalog():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.filter("intact").count() == df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    assert differences(df.collect(), df.columns, con.execute(SQL[name])) is None
