"""Every query of the library against its SQL in DuckDB, row by row."""

import datetime
import decimal
import os

import duckdb
import pytest

from lectern.plans import catalog

FOLDER = os.environ.get("LECTERN_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, int | float | decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return str(v) if isinstance(v, datetime.date) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    sql = ORACLES.get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    assert got == rows(rel.columns, rel.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
