"""Every query with SQL against DuckDB, on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

from hemicycle.plans import analytics, domain, ingest

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = analytics.QUERIES | domain.QUERIES | ingest.QUERIES
SQL = analytics.SQL | domain.SQL | ingest.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if isinstance(v, datetime.datetime | decimal.Decimal) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    assert got == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
