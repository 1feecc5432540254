"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = [tuple(row[c] for c in columns) for row in df.collect()]
    assert rows
    if name not in ORACLES:
        return
    found = database.execute(ORACLES[name])
    have = [d[0] for d in found.description]
    assert sorted(have) == columns
    at = [have.index(c) for c in columns]
    assert _sorted(rows) == _sorted([tuple(row[i] for i in at) for row in found.fetchall()])


def test_approximate_search_finds_most(spark):
    row = QUERIES["v6_approximate_quality"](spark, FOLDER).first()
    assert row["recall"] > 0.7
    assert 0.2 < row["share_scored"] < 0.8


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["query_id", "rank", "id", "doc_id", "chunk_pos", "content", "score"]
    assert df.count() == 120
