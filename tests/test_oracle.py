"""Every registered query against its SQL, on the given tables and on skewed copies."""

import sys

import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module
from millrace.plans import catalog
from millrace.sources.tables import TABLE_NAMES

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()

# One key of each table holds a third of its rows.
HOT = {
    "orders": """SELECT * REPLACE (CASE WHEN h = 0 THEN 7 ELSE o_custkey END AS o_custkey,
                 CASE WHEN h = 1 THEN TIMESTAMP '1997-01-01' ELSE o_orderdate END AS o_orderdate)""",
    "lineitem": """SELECT * REPLACE (CASE WHEN h = 0 THEN 5 ELSE l_partkey END AS l_partkey,
                   CASE WHEN h = 1 THEN 5 ELSE l_suppkey END AS l_suppkey,
                   CASE WHEN h = 2 THEN 11 ELSE l_orderkey END AS l_orderkey)""",
    "events": "SELECT * REPLACE (CASE WHEN h = 0 THEN 3 ELSE user_id END AS user_id)",
    "documents": "SELECT * REPLACE (CASE WHEN h = 0 THEN 'one text' ELSE text END AS text)",
}


@pytest.fixture(scope="module")
def plain_sql(folder):
    return connect(folder)


@pytest.fixture(scope="module")
def hot_folder(folder, tmp_path_factory):
    target = tmp_path_factory.mktemp("hot")
    writer = duckdb.connect()
    for name in TABLE_NAMES:
        source = f"(SELECT *, row_number() OVER () % 3 AS h FROM '{folder}/{name}.parquet')"
        query = f"SELECT * EXCLUDE (h) FROM ({HOT.get(name, 'SELECT *')} FROM {source})"
        writer.execute(f"COPY ({query}) TO '{target}/{name}.parquet' (FORMAT parquet)")
    return str(target)


@pytest.fixture(scope="module")
def hot_sql(hot_folder):
    return connect(hot_folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, folder, plain_sql, name):
    count, difference = compare(QUERIES[name](spark, folder), plain_sql, SQL[name])
    assert difference is None
    assert count > 0


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql_with_hot_keys(spark, hot_folder, hot_sql, name):
    _, difference = compare(QUERIES[name](spark, hot_folder), hot_sql, SQL[name])
    assert difference is None


def test_the_library_works_without_the_optional_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "millrace.llm", None)
    assert set(entry_module.queries()) == set(QUERIES) and set(entry_module.oracle_sql()) == set(SQL)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
