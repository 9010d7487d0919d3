"""Queries with SQL against DuckDB, on the given tables."""

import duckdb
import pytest

from footfall.llm.queries import ORACLE_SQL, QUERIES

TABLES = ("documents", "benchmark", "embeddings", "conversations")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    expected = duck.sql(ORACLE_SQL[name])
    assert sorted(expected.columns) == columns
    picked = expected.project(", ".join(f'"{c}"' for c in columns))
    found = [tuple(row) for row in frame.select(columns).collect()]
    assert sorted(found, key=str) == sorted(picked.fetchall(), key=str)


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
