"""The training-data queries that SQL expresses, against DuckDB."""

import pytest

from freshet.llm import catalog
from tests.oracle_check import compare, duck_connection


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, name, sf_dir):
    res = compare(spark, name, catalog.queries()[name], catalog.oracle_sql()[name], sf_dir, duck_connection(sf_dir))
    assert res["ok"], res
