"""Every query that has a SQL check, against DuckDB on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
CHECKS = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.LLM_CHECKS}
QUERIES = {name: run for name, run in entry.queries().items() if name not in entry.LLM_QUERIES}
#: What trained models say; the queries next to them show what is certain of it.
ROWS_ONLY = {"model_metrics", "feature_importances", "predictions"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def test_only_model_queries_have_no_check():
    assert set(QUERIES) - set(CHECKS) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_check(name, spark, folder, duck):
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    got = [tuple(plain(row[c]) for c in columns) for row in result.collect()]
    cursor = duck.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = [tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
