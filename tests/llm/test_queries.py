"""Queries with a SQL counterpart against it, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from topictally.llm import queries as llm

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", [n for n, sql in llm.oracle_sql().items() if sql])
def test_query(spark, database, name):
    df = llm.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    names = ", ".join(f'"{c}"' for c in columns)
    expected = database.execute(f"SELECT {names} FROM ({llm.oracle_sql()[name]})").fetchall()
    assert got == sorted(expected, key=repr)
    assert got
