"""Small queries, crosswalk lookups, per-state imports, batch groupings and pattern actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators.relational import latest_per_key, upsert
from .aggregations import SKIPS, skips
from .joins import newest
from .model import attempts, bell, counts, districts, enrollment, requirements
from .ordering import _PRIORITY, priorities
from .projections import sped
from .registry import query, share
from .state import patterns

c = F.col


# ---- queries
@query("q_bell", "SELECT bell_id, grade_level, minutes FROM bell WHERE (district_id = '0000042' OR ltrim(district_id, '0') = '42') AND year = 1998")
def _(t):
    return bell(t).where((c("district_id") == "0000042") | (T.strip_zeros(c("district_id")) == "42")).where("year = 1998").select("bell_id", "grade_level", "minutes")


@query("q_state_req", "SELECT state, coalesce(nullif(high, 0), fallback) AS minutes FROM requirements WHERE state = upper('nation_4')")
def _(t):
    return requirements(t).where(c("state") == F.upper(F.lit("nation_4"))).select("state", F.coalesce(F.nullif("high", F.lit(0)), "fallback").alias("minutes"))


@query("q_report", "SELECT method || ': ' || format('{:,}', n) AS line FROM (SELECT method, count(*) AS n FROM bell GROUP BY 1) ORDER BY method")
def _(t):
    n = bell(t).groupBy("method").agg(F.count("*").alias("n"))
    return n.orderBy("method").select(F.concat("method", F.lit(": "), T.thousands(c("n"))).alias("line"))


@query("q_skip_list", f"SELECT d.state, d.name, s.n FROM ({SKIPS}) s JOIN districts d ON s.district_id = d.district_id ORDER BY d.state, d.name")
def _(t):
    return skips(t).join(districts(t), "district_id").select("state", "name", "n").orderBy("state", "name")


@query("q_attempt_sum", "SELECT status, count(*) AS n, count(DISTINCT district_id) AS districts FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("district_id").alias("districts"))


_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("q_table_counts", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in _NAMES))
def _(t):
    return reduce(lambda a, b: a.unionByName(b), [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in _NAMES])


@query("q_overall", "SELECT count(*) AS total, count(*) FILTER (district_id IN (SELECT district_id FROM bell WHERE year = 1998)) AS enriched, round(count(*) FILTER (district_id IN (SELECT district_id FROM bell WHERE year = 1998)) * 100.0 / count(*), 4) AS rate FROM districts")
def _(t):
    b = bell(t, 1998).select("district_id").distinct().withColumn("has", F.lit(1))
    return districts(t).join(b, "district_id", "left").agg(F.count("*").alias("total"), F.count("has").alias("enriched"), F.round(F.count("has") * 100.0 / F.count("*"), 4).alias("rate"))


@query("q_progress_txt", "SELECT state || ': ' || count(*) || ' districts' AS line FROM districts GROUP BY state ORDER BY state")
def _(t):
    return districts(t).groupBy("state").agg(F.count("*").alias("n")).orderBy("state").select(F.format_string("%s: %d districts", "state", "n").alias("line"))


@query("q_min_enroll", "SELECT district_id, total FROM newest WHERE total >= 500")
def _(t):
    return newest(t).where("total >= 500").select("district_id", "total")


@query("q_mark_priority", f"SELECT d.district_id, coalesce(CAST(trunc(p.priority) AS INTEGER), 0) AS priority FROM districts d LEFT JOIN ({_PRIORITY}) p ON p.district_id = d.district_id")
def _(t):
    return districts(t).select("district_id").join(priorities(t).select("district_id", "priority"), "district_id", "left").select("district_id", F.coalesce(c("priority").cast("int"), F.lit(0)).alias("priority"))


@query("q_export_cand", f"SELECT district_id || ',' || state AS line FROM ({_PRIORITY}) ORDER BY priority DESC, district_id LIMIT 15")
def _(t):
    return priorities(t).orderBy(F.desc("priority"), "district_id").limit(15).select(F.to_csv(F.struct("district_id", "state")).alias("line"))


@query("q_lookup_id", "SELECT district_id, name FROM districts WHERE district_id = '0000011'")
def _(t):
    return districts(t, 11).select("district_id", "name")


@query("q_search", "SELECT district_id, name FROM districts WHERE regexp_matches(name, '(?i)er#.*5$') AND state = 'NATION_2'")
def _(t):
    return districts(t).where(c("name").rlike("(?i)er#.*5$") & (c("state") == "NATION_2")).select("district_id", "name")


@query("q_override_hist", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'signup' AND ts > TIMESTAMP '2024-01-20' ORDER BY ts DESC, event_id")
def _(t):
    e = t.events.where((c("event_type") == "signup") & (c("ts") > F.lit("2024-01-20").cast("timestamp_ntz"))).orderBy(F.desc("ts"), "event_id")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("q_claim", "SELECT 120 AS claimed, n AS actual, CASE WHEN n = 0 THEN 'critical' WHEN n BETWEEN 98 AND 142 THEN 'info' WHEN n > 240 OR 2 * n < 120 THEN 'critical' ELSE 'warning' END AS severity FROM (SELECT count(*) AS n FROM districts)")
def _(t):
    n = districts(t).agg(F.count("*").cast("int").alias("actual"))
    return n.select(F.lit(120).alias("claimed"), c("actual").cast("long").alias("actual"), N.discrepancy(F.lit(120), c("actual"))["severity"].alias("severity"))


@query("q_banner", "SELECT 'WARNING: ' || count(*) || ' schedules without minutes' AS banner FROM bell WHERE minutes = 0")
def _(t):
    return bell(t).where("minutes = 0").agg(F.format_string("WARNING: %d schedules without minutes", F.count("*")).alias("banner"))


# ---- crosswalks
share("state_ids", "SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS district_id, n_name AS state, lpad(CAST(c_custkey * 3 AS VARCHAR), 7, '0') AS state_id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 0")


def state_ids(t):
    d = t.customer.where("c_custkey % 10 <> 0").join(F.broadcast(t.nation), c("c_nationkey") == c("n_nationkey"))  # the states are a fixed list
    return d.select(F.lpad(c("c_custkey").cast("string"), 7, "0").alias("district_id"), c("n_name").alias("state"), F.lpad((c("c_custkey") * 3).cast("string"), 7, "0").alias("state_id"))


@query("x_state_map", "SELECT state_id, district_id FROM state_ids WHERE state = 'NATION_6'")
def _(t):
    return state_ids(t).where("state = 'NATION_6'").select("state_id", "district_id")


@query("x_nces", "SELECT district_id FROM state_ids WHERE state_id = '0000033'")
def _(t):
    return state_ids(t).where("state_id = '0000033'").select("district_id")


@query("x_name", "SELECT name FROM districts WHERE district_id = '0000013'")
def _(t):
    return districts(t, 13).select("name")


_INFO = [("CA", "county-district-school", 7), ("TX", "county-district", 6), ("IL", "region-county-district-type", 13), ("??", "Unknown", None)]


@query("x_id_info", "SELECT state, format, digits FROM (VALUES " + ", ".join(f"('{a}', '{b}', {'NULL' if n is None else n})" for a, b, n in _INFO) + ") v(state, format, digits)")
def _(t):
    return t.values("state string, format string, digits int", *_INFO)


@query("x_cds_nces", "SELECT district_id, left(state_id, 2) || substr(state_id, 3, 5) AS code FROM state_ids WHERE state = 'NATION_1'")
def _(t):
    county, district = T.county_parts(c("state_id"))
    return state_ids(t).where("state = 'NATION_1'").select("district_id", F.concat(county, district).alias("code"))


@query("x_cds_bulk", "SELECT s.id AS code, x.district_id FROM (SELECT lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS id FROM supplier) s LEFT JOIN state_ids x ON x.state_id = s.id")
def _(t):
    s = t.supplier.select(F.lpad(c("s_suppkey").cast("string"), 7, "0").alias("code"))
    return s.join(state_ids(t).select(c("state_id").alias("code"), "district_id"), "code", "left")


@query("x_cds_district", "SELECT d.district_id, d.name FROM districts d JOIN state_ids x ON x.district_id = d.district_id WHERE x.state_id = '0000021'")
def _(t):
    return districts(t).join(state_ids(t).where("state_id = '0000021'").select("district_id"), "district_id").select("district_id", "name")


@query("x_stleaid_fill", "SELECT d.district_id, coalesce(x.state_id, 'none') AS state_id FROM districts d LEFT JOIN state_ids x ON ltrim(x.district_id, '0') = ltrim(d.district_id, '0')")
def _(t):
    x = state_ids(t).select(T.strip_zeros(c("district_id")).alias("key"), "state_id")
    return districts(t).select("district_id", T.strip_zeros(c("district_id")).alias("key")).join(x, "key", "left").select("district_id", F.coalesce("state_id", F.lit("none")).alias("state_id"))


@query("x_build", "SELECT state, count(*) AS n FROM state_ids GROUP BY 1 ORDER BY n DESC, state LIMIT 5")
def _(t):
    return state_ids(t).groupBy("state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "state").limit(5)


@query("x_tx", "SELECT d.district_id, coalesce(x.state_id, 'csv-' || d.district_id) AS state_id, CASE WHEN contains(d.segment, 'BUILD') THEN 'charter' ELSE 'regular' END AS type FROM districts d LEFT JOIN state_ids x ON x.district_id = d.district_id WHERE d.enrollment > 0")
def _(t):
    d = districts(t).where("enrollment > 0").join(state_ids(t).select("district_id", "state_id"), "district_id", "left")
    return d.select("district_id", F.coalesce("state_id", F.concat(F.lit("csv-"), "district_id")).alias("state_id"), F.when(c("segment").contains("BUILD"), "charter").otherwise("regular").alias("type"))


@query("x_urls", "SELECT d.district_id, 'https://' || x.state_id AS url FROM districts d JOIN state_ids x ON x.district_id = d.district_id WHERE ('https://' || x.state_id) IS DISTINCT FROM CASE WHEN d.enrollment > 3000 THEN 'https://' || x.state_id END")
def _(t):
    x = districts(t).join(state_ids(t).select("district_id", T.normal_url(c("state_id")).alias("url")), "district_id").withColumn("old", F.when(c("enrollment") > 3000, c("url")))
    return x.where(~c("url").eqNullSafe(c("old"))).select("district_id", "url")


# ---- per-state imports: one shape, read from yearly counts by category
_STATES = ("CA", "FL", "IL", "MA", "MI", "NY", "PA", "TX", "VA")


def state_code(t):
    """Yearly counts with one of nine states, by the district's id."""
    return counts(t).withColumn("st", F.element_at(F.array(*map(F.lit, _STATES)), c("district_id").cast("int") % 9 + 1))


share("statecounts", "SELECT *, [" + ", ".join(f"'{s}'" for s in _STATES) + "][CAST(district_id AS INTEGER) % 9 + 1] AS st FROM counts")


@query("i_idents", "SELECT DISTINCT s.district_id, x.state_id FROM statecounts s JOIN state_ids x ON x.district_id = s.district_id WHERE s.st = 'MI'")
def _(t):
    ids = state_code(t).where("st = 'MI'").select("district_id").distinct()
    return ids.join(state_ids(t).select("district_id", "state_id"), "district_id")


_CODES = "SELECT CAST(s_suppkey AS VARCHAR) AS raw FROM supplier"


@query("i_il_code", f"SELECT raw, substr(p, 1, 2) || '-' || substr(p, 3, 3) || '-' || substr(p, 6, 4) || '-' || substr(p, 10, 2) AS code FROM (SELECT raw, lpad(raw, 11, '0') AS p FROM ({_CODES}))")
def _(t):
    p = F.lpad("raw", 11, "0")
    return t.supplier.select(c("s_suppkey").cast("string").alias("raw")).select("raw", F.concat_ws("-", F.substring(p, 1, 2), F.substring(p, 3, 3), F.substring(p, 6, 4), F.substring(p, 10, 2)).alias("code"))


@query("i_ma_code", f"SELECT raw, left(lpad(raw, 8, '0'), 4) AS code FROM ({_CODES})")
def _(t):
    return t.supplier.select(c("s_suppkey").cast("string").alias("raw")).select("raw", T.state_district_id(F.lit("MA"), c("raw")).alias("code"))


@query("i_va_code", f"SELECT raw, CASE WHEN length(raw) >= 3 THEN raw ELSE lpad(raw, 3, '0') END AS code FROM ({_CODES})")
def _(t):
    return t.supplier.select(c("s_suppkey").cast("string").alias("raw")).select("raw", T.zero_fill(c("raw"), 3).alias("code"))


@query("i_frpm", "SELECT district_id, year, round(CAST(prek AS DOUBLE) / total, 6) AS poverty FROM enrollment WHERE coalesce(total, 0) <> 0")
def _(t):
    return enrollment(t).where("coalesce(total, 0) <> 0").select("district_id", "year", F.round(c("prek") / c("total"), 6).alias("poverty"))


@query("i_ccd_total", "SELECT coalesce(b.district_id, e.district_id) AS district_id, e.total, CASE WHEN b.district_id IS NOT NULL AND e.district_id IS NOT NULL THEN round(CAST(b.sped AS DOUBLE) / nullif(e.total, 0), 6) END AS ratio FROM (SELECT * FROM lastsped WHERE confidence = 'medium') b FULL JOIN newest e ON e.district_id = b.district_id")
def _(t):
    b = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).where("confidence = 'medium'").select("district_id", "sped")
    return b.join(newest(t).select("district_id", "total"), "district_id", "full").select("district_id", "total", F.round(F.try_divide(c("sped").cast("double"), F.nullif("total", F.lit(0)).cast("double")), 6).alias("ratio"))


@query("i_sped_save", "SELECT district_id, year, sped FROM sped WHERE year >= 1998 UNION ALL SELECT district_id, year, -1 FROM sped WHERE year < 1998")
def _(t):
    old = sped(t).select("district_id", "year", F.lit(-1).cast("long").alias("sped"))
    return upsert(old, sped(t).where("year >= 1998").select("district_id", "year", "sped"), ["district_id", "year"])


@query("i_sped_sample", "SELECT district_id, pupils, round(sped * 100.0 / pupils, 4) AS percent FROM lastsped WHERE confidence <> 'low' ORDER BY pupils DESC, district_id LIMIT 10")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).where("confidence <> 'low'")
    return p.orderBy(F.desc("pupils"), "district_id").limit(10).select("district_id", "pupils", F.round(c("sped") * 100.0 / c("pupils"), 4).alias("percent"))


# ---- batches and patterns
@query("b_groupers", "SELECT attempt_id, 'cms_' || coalesce(block_type, 'unknown') AS by_cms, 'state_' || coalesce(status, 'unknown') AS by_state FROM attempts")
def _(t):
    key = lambda p, n: F.concat(F.lit(p), F.coalesce(n, F.lit("unknown")))
    return attempts(t).select("attempt_id", key("cms_", "block_type").alias("by_cms"), key("state_", "status").alias("by_state"))


@query("b_context", "SELECT district_id, string_agg(attempt_id || ':' || status, ',' ORDER BY attempt_id) AS context FROM attempts WHERE k < 30 GROUP BY 1")
def _(t):
    rows = F.array_sort(F.collect_list(F.struct("attempt_id", "status")))
    return attempts(t).where("k < 30").groupBy("district_id").agg(F.array_join(F.transform(rows, lambda r: F.concat(r["attempt_id"].cast("string"), F.lit(":"), r["status"])), ",").alias("context"))


@query("p_approve", "SELECT pattern, CASE WHEN pattern = '*p7*' THEN 'approved' ELSE status END AS status FROM patterns WHERE pattern <> '*p9*'")
def _(t):
    return patterns(t).where("pattern <> '*p9*'").select("pattern", F.when(c("pattern") == "*p7*", "approved").otherwise(c("status")).alias("status"))


@query("p_format", "SELECT page_id, '[' || page_id || '] ' || coalesce(url, '') AS line FROM pages")
def _(t):
    return t.pages.select("page_id", F.format_string("[%d] %s", "page_id", F.coalesce("url", F.lit(""))).alias("line"))
