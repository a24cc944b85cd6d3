"""The tables at hand seen as a district's records, once as DataFrames and once as SQL.

customer is the district directory, lineitem with orders the yearly staff and enrollment counts, orders the daily
schedules, nation the state requirements, events the enrichment attempts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables, share

GRADES = {1: "PK", 2: "KG", 3: "01", 4: "05", 5: "06", 6: "08", 7: "09"}
LEVELS = {"1-URGENT": "high", "2-HIGH": "middle", "3-MEDIUM": "elementary", "4-NOT SPECIFIED": "k8", "5-LOW": "k12"}
CONFIDENCE = {"F": "high", "O": "medium", "P": "low"}
STATUS = {"error": "blocked", "view": "not_found", "click": "success", "signup": "timeout", "purchase": "success"}
CATEGORIES = ("AF", "AO", "NF", "NO", "RF", "RO")
STAFF = dict(AF="elementary", AO="secondary", NF="kindergarten", NO="ungraded", RF="paras", RO="coordinators")


def school_year(date: str):
    return F.concat(F.year(date).cast("string"), F.lit("-"), F.lpad(((F.year(date) + 1) % 100).cast("string"), 2, "0"))


def districts(t: Tables, key: int | None = None) -> DataFrame:
    """The directory; one district by its number, which the scan can skip rows by."""
    customer = t.customer if key is None else t.customer.where(F.col("c_custkey") == key)
    c = customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # the states are a fixed list
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("district_id"), F.col("c_name").alias("name"), F.col("n_name").alias("state"), F.col("n_regionkey").alias("region"),
        F.floor("c_acctbal").alias("enrollment"), F.col("c_mktsegment").alias("segment"), (F.col("c_custkey") % 17 == 0).alias("shared_service"),
    )


share("districts", """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS district_id, c_name AS name, n_name AS state, n_regionkey AS region,
           CAST(floor(c_acctbal) AS BIGINT) AS enrollment, c_mktsegment AS segment, c_custkey % 17 = 0 AS shared_service
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")


def bell(t: Tables, year: int | None = None) -> DataFrame:
    """The schedules; those of one year by a range of dates, which the scan can skip files by."""
    orders = t.orders if year is None else t.orders.where((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("date")) & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("date")))
    level = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    conf = F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv])
    return orders.select(
        F.col("o_orderkey").alias("bell_id"), F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("district_id"), F.year("o_orderdate").alias("year"),
        level[F.col("o_orderpriority")].alias("grade_level"), (F.floor("o_totalprice") % 500).alias("minutes"), conf[F.col("o_orderstatus")].alias("confidence"),
        F.when(F.col("o_orderkey") % 3 == 0, "human_provided").when(F.col("o_orderkey") % 3 == 1, "pdf_text").otherwise("web_page").alias("method"), F.to_date("o_orderdate").alias("created"),
    )


share("bell", f"""
    SELECT o_orderkey AS bell_id, lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS district_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEVELS.items())} END AS grade_level,
           CAST(floor(o_totalprice) AS BIGINT) % 500 AS minutes, CASE o_orderstatus {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CONFIDENCE.items())} END AS confidence,
           CASE WHEN o_orderkey % 3 = 0 THEN 'human_provided' WHEN o_orderkey % 3 = 1 THEN 'pdf_text' ELSE 'web_page' END AS method, CAST(o_orderdate AS DATE) AS created
    FROM orders""")


def counts(t: Tables) -> DataFrame:
    """Yearly counts by category and grade: (district_id, year, category, grade, n, source)."""
    grade = F.create_map(*[F.lit(x) for kv in GRADES.items() for x in kv])
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.lpad(F.col("o_custkey").cast("string"), 7, "0").alias("district_id"), F.year("o_orderdate").alias("year"), F.concat("l_returnflag", "l_linestatus").alias("category"),
        grade[F.col("l_linenumber")].alias("grade"), F.col("l_quantity").cast("long").alias("n"), F.when(F.col("l_suppkey") % 2 == 0, "federal").otherwise("state").alias("source"),
    )


share("counts", f"""
    SELECT lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS district_id, CAST(year(o_orderdate) AS INTEGER) AS year, l_returnflag || l_linestatus AS category,
           CASE l_linenumber {" ".join(f"WHEN {k} THEN '{v}'" for k, v in GRADES.items())} END AS grade, CAST(l_quantity AS BIGINT) AS n,
           CASE WHEN l_suppkey % 2 = 0 THEN 'federal' ELSE 'state' END AS source
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")


def staff(t: Tables) -> DataFrame:
    """One row for each district and year with a column for each staff category; what nobody reported is null."""
    wide = counts(t).groupBy("district_id", "year").pivot("category", list(CATEGORIES)).agg(F.sum("n"))
    return wide.select("district_id", "year", *[F.col(k).alias(v) for k, v in STAFF.items()])


share("staff", f"""
    SELECT district_id, year, {", ".join(f"CAST(sum(n) FILTER (category = '{k}') AS BIGINT) AS {v}" for k, v in STAFF.items())}
    FROM counts GROUP BY district_id, year""")


def enrollment(t: Tables) -> DataFrame:
    """One row for each district and year: pupils in all (ten for each count), and those before kindergarten."""
    return counts(t).groupBy("district_id", "year").agg((F.sum("n") * 10).alias("total"), (F.sum(F.when(F.col("grade") == "PK", F.col("n"))) * 10).alias("prek"))


def staff_and_enrollment(t: Tables) -> DataFrame:
    """staff() and enrollment() side by side, from one scan of the counts."""
    sums = [F.sum(F.when(F.col("category") == k, F.col("n"))).alias(v) for k, v in STAFF.items()]
    return counts(t).groupBy("district_id", "year").agg(*sums, (F.sum("n") * 10).alias("total"), (F.sum(F.when(F.col("grade") == "PK", F.col("n"))) * 10).alias("prek"))


share("enrollment", """
    SELECT district_id, year, CAST(sum(n) * 10 AS BIGINT) AS total, CAST(sum(n) FILTER (grade = 'PK') * 10 AS BIGINT) AS prek
    FROM counts GROUP BY district_id, year""")


def requirements(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return t.nation.select(F.col("n_name").alias("state"), (300 + 5 * k).alias("high"), F.when(k % 3 == 0, 0).otherwise(290 + k).alias("middle"), F.when(k % 5 != 0, 280 + k).alias("elementary"), F.lit(330).alias("fallback"))


share("requirements", """
    SELECT n_name AS state, 300 + 5 * n_nationkey AS high, CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE 290 + n_nationkey END AS middle,
           CASE WHEN n_nationkey % 5 <> 0 THEN 280 + n_nationkey END AS elementary, 330 AS fallback
    FROM nation""")


def lea_ratios(t: Tables) -> DataFrame:
    """(district_id, proportion): the share of pupils in special education that a quarter of the districts reported."""
    k = F.col("c_custkey")
    return t.customer.where(k % 4 == 1).select(F.lpad(k.cast("string"), 7, "0").alias("district_id"), ((k % 20 + 5) / 100).alias("proportion"))


share("learatios", "SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS district_id, CAST(c_custkey % 20 + 5 AS DOUBLE) / 100 AS proportion FROM customer WHERE c_custkey % 4 = 1")


def state_ratios(t: Tables) -> DataFrame:
    """(state, proportion, self_contained, teacher_ratio, instructional_ratio), each unknown in some states."""
    k = F.col("n_nationkey")
    some = lambda n, r, x: F.when(k % n != r, x / 100)
    return t.nation.select(F.col("n_name").alias("state"), some(6, 5, k + 10).alias("proportion"), some(5, 4, k + 20).alias("self_contained"), some(4, 3, k % 8 + 5).alias("teacher_ratio"), some(12, 8, k % 5 + 12).alias("instructional_ratio"))


share("stateratios", """
    SELECT n_name AS state, CASE WHEN k % 6 <> 5 THEN (k + 10) / 100 END AS proportion, CASE WHEN k % 5 <> 4 THEN (k + 20) / 100 END AS self_contained,
           CASE WHEN k % 4 <> 3 THEN (k % 8 + 5) / 100 END AS teacher_ratio, CASE WHEN k % 12 <> 8 THEN (k % 5 + 12) / 100 END AS instructional_ratio
    FROM (SELECT n_name, CAST(n_nationkey AS DOUBLE) AS k FROM nation)""")


def attempts(t: Tables) -> DataFrame:
    status = F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv])
    k = F.get_json_object("props", "$.k").cast("int")
    e = t.events.select(F.col("event_id").alias("attempt_id"), F.lpad(F.col("user_id").cast("string"), 7, "0").alias("district_id"), status[F.col("event_type")].alias("status"), F.col("event_type"), F.round(F.col("value") * 100).cast("long").alias("timing"), F.col("ts").alias("attempted"), k.alias("k"))
    kind = F.try_element_at(F.array(F.lit("cloudflare"), F.lit("captcha"), F.lit("waf")), F.col("k") % 4 + 1)
    return e.withColumns({"block_type": F.when(F.col("status") == "blocked", kind), "skip": F.col("k") % 50 == 0})


share("attempts", f"""
    SELECT event_id AS attempt_id, lpad(CAST(user_id AS VARCHAR), 7, '0') AS district_id, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items())} END AS status, event_type,
           CAST(round(value * 100) AS BIGINT) AS timing, ts AS attempted, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CASE WHEN event_type = 'error' THEN ['cloudflare', 'captcha', 'waf', NULL][CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] END AS block_type,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 = 0 AS skip
    FROM events""")
