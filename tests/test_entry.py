"""Every query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

TABLES = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@needs_tables
@pytest.mark.parametrize("name", list(driver.own_queries()))
def test_query(spark, database, name):
    df = driver.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    names = ", ".join(f'"{c}"' for c in columns)
    sql = f"SELECT {names} FROM ({driver.oracle_sql()[name]})"
    expected = sorted(database.execute(sql).fetchall(), key=repr)
    assert got == expected
    assert got


def test_every_query_has_sql():
    assert set(driver.own_sql()) == set(driver.own_queries())


@needs_tables
def test_entry(spark):
    assert driver.entry(spark).columns == ["windowStart", "region", "count"]


@needs_tables
@pytest.mark.parametrize("name", ["event_type_count", "stream_region_count", "stream_changes"])
def test_tables_may_be_folders_of_files(spark, database, tmp_path, name):
    events = spark.read.parquet(str(TABLES / "events.parquet"))
    events.repartitionByRange(3, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    df = driver.queries()[name](spark, str(tmp_path))
    expected = database.execute(driver.oracle_sql()[name]).fetchall()
    assert df.count() == len(expected)
