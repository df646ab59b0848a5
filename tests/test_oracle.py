"""Every registered query against its SQL counterpart, value by value."""

import duckdb
import pytest

from check import TABLES, rows_of
from conftest import SF_SMALL

from basketry.registry.oracle import oracle_sql
from basketry.registry.queries import QUERIES

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_SMALL}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_SMALL)
    got = rows_of(frame.columns, frame.collect())
    result = db.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert got == rows_of(result.columns, result.fetchall())
