"""What the plans look like: pruned scans, pushed filters, no row-at-a-time Python."""

import os

import duckdb
import pytest

from lectern.plans import catalog
from lectern.plans.registry import Tables, complete

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plan(spark, name):
    return catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "flt_level_D")
    assert "PushedFilters: [" in p and "EqualTo(o_orderpriority" in p or "IsNotNull(o_orderpriority)" in p
    p = plan(spark, "flt_type_district")
    assert "EqualTo(p_type,ECONOMY)" in p and "ReadSchema: struct<p_partkey:bigint,p_type:string>" in p


def test_lookups_push_their_keys_and_dates(spark):
    assert "EqualTo(c_custkey,11)" in plan(spark, "q_lookup_id")
    p = plan(spark, "agg_enrich_state")
    assert "derdate,1999-01-01T00:00), LessThan(o_orderdate,2" in p


def scans(spark, name, column):
    return plan(spark, name).split("== Initial Plan ==")[0].count(f"ReadSchema: struct<{column}")


def test_the_counts_are_read_once(spark):
    for name in ("agg_mv_stats", "lct_all", "jn_3way", "agg_scope_summary", "dq_safeguards"):
        assert scans(spark, name, "l_orderkey") == 1, name
    assert scans(spark, "dq_qa_report", "l_orderkey") == 0  # it reads the stored run


def test_tops_need_no_full_sort(spark):
    for name in ("top_n", "top_targets", "flt_ilike"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_aggregates_combine_before_the_shuffle(spark):
    p = plan(spark, "agg_attempts")
    assert "partial_" in p


def test_names_are_combined_where_equal_ones_are_together(spark):
    # a task that combines what it scans would hold all of that
    above, below = plan(spark, "tx_subdomains").split("Exchange hashpartitioning(", 1)
    assert "HashAggregate" in above and "HashAggregate" not in below and "Generate" not in below


def test_an_address_stands_once(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT * FROM '{FOLDER}/nation.parquet') TO '{tmp_path}/nation.parquet'")
    names = "(1, 'Oak#1'), (2, 'OAK1'), (3, NULL), (4, NULL), (5, ''), (6, 'a.b'), (7, 'Oak1'), (8, '#')"
    duckdb.sql(f"COPY (SELECT CAST(k AS BIGINT) AS c_custkey, n AS c_name, CAST(0 AS INTEGER) AS c_nationkey, CAST(1 AS DOUBLE) AS c_acctbal, 'x' AS c_mktsegment FROM (VALUES {names}) v(k, n)) TO '{tmp_path}/customer.parquet'")
    con = duckdb.connect()
    for t in ("customer", "nation"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = sorted(map(tuple, catalog.queries()["tx_subdomains"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(con.sql(catalog.oracle_sql()["tx_subdomains"]).fetchall(), key=str) and len(got) == 16


@pytest.mark.parametrize("name", [n for n in sorted(catalog.queries()) if n.split("_")[0] in ("prj", "flt", "agg", "win", "set", "rsh", "dq", "lct")])
def test_no_python_in_the_plan(name, spark):
    p = plan(spark, name)
    assert "Python" not in p and "Pandas" not in p and "CartesianProduct" not in p


def test_shared_expressions_are_named_once():
    text = complete("WITH x AS (SELECT 1) SELECT * FROM lctrows JOIN staff ON true")
    assert text.count(" staff AS (") + text.count("WITH staff AS (") == 1 and text.index("counts AS") < text.index("staff AS")
    assert complete("WITH RECURSIVE e AS (SELECT 1) SELECT * FROM attempts").startswith("WITH RECURSIVE attempts AS")


def test_a_table_is_read_when_named(spark):
    with pytest.raises(AttributeError):
        Tables(spark, FOLDER)._nothing
