"""Every query that has SQL gives the rows that DuckDB gives; the others give rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from sparkloom.plans import files  # noqa: F401
from sparkloom.plans.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf, duck, name):
    frame = QUERIES[name](spark, sf)
    columns = sorted(frame.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in frame.collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want and got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"prune_loop", "break_loop"}))
def test_others_give_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
