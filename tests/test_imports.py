"""State imports over districts whose numbers are longer than their state writes them, against the SQL."""

import duckdb
import pytest

from lectern.plans import catalog
from lectern.plans.imports import STATES

NUMBERS = (0, 5, 7, 999, 1_000, 1_001, 9_999, 10_000, 10_001, 10_006, 100_000, 100_004, 999_999, 1_000_000, 1_000_004, 1_000_040)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """A customer with one order of one line for each of NUMBERS in each state; the line's quantity tells them apart."""
    at = tmp_path_factory.mktemp("wide")
    con = duckdb.connect()
    con.sql(f"CREATE TABLE k AS SELECT m * 9 + s AS key, 1 + row_number() OVER (ORDER BY m, s) AS i FROM (SELECT unnest({list(NUMBERS)}) AS m) CROSS JOIN range({len(STATES)}) r(s)")
    con.sql(f"COPY (SELECT i AS o_orderkey, key AS o_custkey, TIMESTAMP '1997-05-05' AS o_orderdate FROM k) TO '{at}/orders.parquet'")
    con.sql(f"COPY (SELECT i AS l_orderkey, i AS l_suppkey, 'A' AS l_returnflag, CASE WHEN i % 2 = 0 THEN 'F' ELSE 'O' END AS l_linestatus, CAST(i % 7 + 1 AS INTEGER) AS l_linenumber, CAST(i AS DOUBLE) AS l_quantity FROM k) TO '{at}/lineitem.parquet'")
    return str(at)


@pytest.mark.parametrize("name", ["i_ca_staff", "i_fl", "i_il", "i_il_enrollment", "i_ma", "i_ma_enrollment", "i_mi", "i_ny", "i_pa", "i_tx", "i_tx_staff", "i_va"])
def test_long_numbers_stay_apart(name, spark, folder):
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.queries()[name](spark, folder)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert len(want) > 5
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
