"""Every registered query of the engine runs; those with SQL give DuckDB's rows."""

import math

import duckdb
import pytest

from fitloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
#: Queries without SQL: a tokenizer's, which test_more.py holds to plain packing.
NO_SQL = {"EXT9_packed"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    assert got


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == NO_SQL
