"""Every registered query against its DuckDB counterpart."""

import os
import re

import pytest

from registry.compare import differences
from registry.duckdb_queries import all_sql
from registry.spark_queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()


def test_each_query_has_sql_and_nothing_is_cut():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 80
    for name, sql in SQL.items():
        if not name.startswith("ch"):
            assert not re.search(r"\b(LIMIT|SAMPLE|TABLESAMPLE)\b", sql), name


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_duckdb(spark, name):
    assert differences(spark, FOLDER, QUERIES[name], SQL[name]) == ""
