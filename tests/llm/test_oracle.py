"""The SQL that is handed out for corpus queries, run by DuckDB on the same tables."""

import duckdb
import pytest

from sparkloom.llm.queries import ORACLE, QUERIES

from ..test_queries import TABLES, norm


def test_sql_is_text():
    assert all(isinstance(sql, str) and name in QUERIES for name, sql in ORACLE.items())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = sorted(tuple(map(norm, r)) for r in result.fetchall())
    got = sorted(tuple(norm(r[c]) for c in names) for r in QUERIES[name](spark, sf).collect())
    assert got == want and got
