"""Every registered query against its DuckDB oracle on the test tables."""

import pytest

import __spark_entry__ as entry
from freshet.plans import catalog
from tests.oracle_check import compare, duck_connection

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


def test_every_query_has_an_oracle():
    # publish_gate and the streaming query are checked against the same SQL
    # as their batch twins; nothing is left to a rows-only check.
    assert set(QUERIES) == set(SQL)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    res = compare(spark, name, QUERIES[name], SQL[name], sf_dir, duck)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "rnum"
    assert df.count() > 0
