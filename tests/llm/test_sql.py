"""Queries with SQL, against DuckDB on the smallest tables."""

import pytest

from tabspark.llm import queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    ok, rows, _, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.SQL[name], SF)
    assert ok and rows, detail
