"""Every training-data query that has a SQL check, against DuckDB on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from barograph.llm import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_check(name, spark, folder):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    got = [tuple(row[c] for c in columns) for row in result.collect()]
    cursor = duck.execute(queries.CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
