"""The registered queries of the package against their SQL, value by value."""

import duckdb
import pytest
from check import TABLES, rows_of
from conftest import SF_SMALL

from basketry.llm.oracle import oracle_sql
from basketry.llm.queries import QUERIES

ORACLE = oracle_sql()


def test_names():
    assert set(ORACLE) <= set(QUERIES)
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{SF_SMALL}/{table}.parquet'")
    frame = QUERIES[name](spark, SF_SMALL)
    result = db.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(result.columns, result.fetchall())
