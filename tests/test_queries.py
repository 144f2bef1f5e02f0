"""Registered queries against their SQL on the smallest data."""

import duckdb
import pytest

from checks.compare import TABLES, rows
from checks.oracles import oracle_sql
from checks.queries import registry

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(registry()))
def test_matches_sql(spark, engine, name):
    df = registry()[name](spark, DIRECTORY)
    got = [tuple(r) for r in df.collect()]
    cursor = engine.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, cursor.fetchall())
