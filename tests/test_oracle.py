"""Every query against its SQL, run by DuckDB on the same files."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
OWN = sorted(set(contract.queries()) - set(contract.LLM_QUERIES))
# Spark type to the DuckDB type it must pair with.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def sf_dir(request):
    return DATA / request.param


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _sorted_rows(rows, order):
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is not None, value) for value in row),
    )


def test_every_query_has_sql():
    assert set(OWN) == set(contract.oracle_sql()) - set(contract.LLM_SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = contract.queries()[name](spark, str(sf_dir))
    expected = duck.sql(contract.oracle_sql()[name])

    ours = sorted(range(len(frame.columns)), key=lambda i: frame.columns[i])
    theirs = sorted(range(len(expected.columns)), key=lambda i: expected.columns[i])
    assert [frame.columns[i] for i in ours] == [expected.columns[i] for i in theirs]
    assert [TYPES[frame.dtypes[i][1]] for i in ours] == [
        str(expected.types[i]) for i in theirs
    ]
    assert _sorted_rows(frame.collect(), ours) == _sorted_rows(expected.fetchall(), theirs)
