"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators.relational import absent
from .model import attempts, bell, counts, districts, enrollment
from .projections import LCT, facts
from .registry import query

c = F.col


@query("flt_valid_lct", f"SELECT district_id, year, round({LCT}, 6) AS lct FROM facts WHERE ({LCT}) > 0 AND ({LCT}) <= 20")
def _(t):
    lct = c("minutes") * c("staff") / c("pupils")
    return facts(t).where((c("staff") > 0) & (c("pupils") > 0)).where((lct > 0) & (lct <= 20)).select("district_id", "year", F.round(lct, 6).alias("lct"))


@query("flt_valid4", f"""
    SELECT count(*) FILTER (pupils > 0 AND staff > 0 AND ({LCT}) <= minutes AND staff <= pupils) AS valid, count(*) FILTER (pupils <= 0) AS no_pupils, count(*) FILTER (staff <= 0) AS no_staff,
           count(*) FILTER (({LCT}) > minutes) AS over_minutes, count(*) FILTER (staff > pupils) AS over_pupils FROM facts""")
def _(t):
    lct = F.when((c("staff") > 0) & (c("pupils") > 0), c("minutes") * c("staff") / c("pupils"))
    n = F.count_if
    return facts(t).agg(n((c("pupils") > 0) & (c("staff") > 0) & (lct <= c("minutes")) & (c("staff") <= c("pupils"))).alias("valid"), n(c("pupils") <= 0).alias("no_pupils"), n(c("staff") <= 0).alias("no_staff"), n(lct > c("minutes")).alias("over_minutes"), n(c("staff") > c("pupils")).alias("over_pupils"))


@query("flt_not_shared", "SELECT b.bell_id FROM bell b JOIN districts d ON b.district_id = d.district_id WHERE NOT d.shared_service")
def _(t):
    return bell(t).join(districts(t).where(~c("shared_service")), "district_id").select("bell_id")


@query("flt_id_either", "SELECT district_id, name FROM districts WHERE district_id = '0000042' OR ltrim(district_id, '0') = '17'")
def _(t):
    return districts(t).where((c("district_id") == "0000042") | (T.strip_zeros(c("district_id")) == "17")).select("district_id", "name")


@query("flt_ilike", "SELECT district_id, name, enrollment FROM districts WHERE name ILIKE '%CUSTOMER#0000000%' AND state = 'NATION_1' ORDER BY enrollment DESC NULLS LAST, district_id LIMIT 50")
def _(t):
    d = districts(t).where(c("name").ilike("%CUSTOMER#0000000%") & (c("state") == "NATION_1"))
    return d.orderBy(F.desc_nulls_last("enrollment"), "district_id").limit(50).select("district_id", "name", "enrollment")


@query("flt_isin_map", "SELECT category, count(*) AS n, CAST(sum(n) AS BIGINT) AS total FROM counts WHERE category IN ('AF', 'NO') GROUP BY 1")
def _(t):
    return counts(t).where(c("category").isin("AF", "NO")).groupBy("category").agg(F.count("*").alias("n"), F.sum("n").alias("total"))


@query("flt_subtotal", "SELECT attempt_id, block_type FROM attempts WHERE block_type IS DISTINCT FROM 'waf'")
def _(t):
    return attempts(t).where(~c("block_type").eqNullSafe("waf")).select("attempt_id", "block_type")


@query("flt_total_indicator", "SELECT bell_id FROM bell WHERE grade_level = 'k12'")
def _(t):
    return bell(t).where(c("grade_level") == "k12").select("bell_id")


@query("flt_contains_ind", "SELECT o_orderkey FROM orders WHERE contains(o_orderpriority, 'SPEC')")
def _(t):
    return t.orders.where(c("o_orderpriority").contains("SPEC")).select("o_orderkey")


@query("flt_level_D", "SELECT bell_id FROM bell WHERE grade_level = 'high' AND confidence = 'high' AND method = 'pdf_text'")
def _(t):
    return bell(t).where((c("grade_level") == "high") & (c("confidence") == "high") & (c("method") == "pdf_text")).select("bell_id")


@query("flt_ca_district", "SELECT attempt_id FROM attempts WHERE (block_type IS NULL OR block_type = '') AND status <> 'timeout' AND event_type = 'view'")
def _(t):
    return attempts(t).where((c("block_type").isNull() | (c("block_type") == "")) & (c("status") != "timeout") & (c("event_type") == "view")).select("attempt_id")


@query("flt_type_district", "SELECT p_partkey, p_type FROM part WHERE p_type = 'ECONOMY'")
def _(t):
    return t.part.where(c("p_type") == "ECONOMY").select("p_partkey", "p_type")


@query("flt_regex_len", "SELECT p_partkey, regexp_extract(p_brand, '#(.*)$', 1) AS code FROM part WHERE length(regexp_extract(p_brand, '#(.*)$', 1)) = 2 AND regexp_full_match(regexp_extract(p_brand, '#(.*)$', 1), '[0-9]+')")
def _(t):
    code = F.regexp_extract("p_brand", "#(.*)$", 1)
    return t.part.select("p_partkey", code.alias("code")).where((F.length("code") == 2) & c("code").rlike("^[0-9]+$"))


@query("flt_ratio_bounds", "SELECT district_id, year FROM enrollment WHERE CAST(prek AS DOUBLE) / total > 0 AND CAST(prek AS DOUBLE) / total < 0.5")
def _(t):
    p = c("prek") / c("total")
    return enrollment(t).where((p > 0) & (p < 0.5)).select("district_id", "year")


@query("flt_len7", "SELECT district_id FROM districts WHERE district_id IS NOT NULL AND length(district_id) = 7")
def _(t):
    return districts(t).where(c("district_id").isNotNull() & (F.length("district_id") == 7)).select("district_id")


@query("flt_range", "SELECT district_id, enrollment FROM districts WHERE enrollment BETWEEN 1000 AND 5000 AND enrollment <= 50000")
def _(t):
    return districts(t).where(c("enrollment").between(1000, 5000) & (c("enrollment") <= 50_000)).select("district_id", "enrollment")


@query("flt_not_exists", "SELECT district_id FROM districts d WHERE NOT EXISTS (SELECT 1 FROM attempts a WHERE a.district_id = d.district_id AND a.skip)")
def _(t):
    return absent(districts(t), attempts(t).where("skip"), ["district_id"]).select("district_id")


@query("flt_date_eq", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(t):
    return t.events.where((c("ts") >= F.lit("2024-01-15").cast("timestamp")) & (c("ts") < F.lit("2024-01-16").cast("timestamp"))).select("event_id")


@query("flt_recent", "SELECT attempt_id FROM attempts WHERE attempted > TIMESTAMP '2024-01-30' - INTERVAL 7 DAY AND status = 'blocked'")
def _(t):
    as_of = F.lit("2024-01-30").cast("timestamp")
    return attempts(t).where((c("attempted") > as_of - F.make_dt_interval(F.lit(7))) & (c("status") == "blocked")).select("attempt_id")


@query("flt_since_run", "SELECT DISTINCT district_id FROM attempts, (SELECT min(ts) + INTERVAL 20 DAY AS done FROM events) r WHERE attempted > done OR k > 95")
def _(t):
    run = t.events.agg((F.min("ts") + F.make_dt_interval(F.lit(20))).alias("done"))
    return attempts(t).crossJoin(F.broadcast(run)).where((c("attempted") > c("done")) | (c("k") > 95)).select("district_id").distinct()  # one run


@query("flt_unenriched", "SELECT attempt_id FROM attempts WHERE NOT coalesce(skip, false)")
def _(t):
    return attempts(t).where(~F.coalesce("skip", F.lit(False))).select("attempt_id")


@query("flt_two_levels", "SELECT district_id, year FROM levels l WHERE CAST(k5 > 300 AS INTEGER) + CAST(g612 > 300 AS INTEGER) + CAST(k12 - k5 - g612 > 0 AS INTEGER) >= 2")
def _(t):
    from .projections import levels

    some = [c("k5") > 300, c("g612") > 300, c("k12") - c("k5") - c("g612") > 0]
    return levels(t).where(sum((s.cast("int") for s in some), F.lit(0)) >= 2).select("district_id", "year")


@query("flt_manual", "SELECT district_id FROM districts WHERE district_id NOT IN ('0000001', '0000005')")
def _(t):
    return absent(districts(t), t.values("district_id string", ("0000001",), ("0000005",)), ["district_id"]).select("district_id")


_YEAR = "year || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0')"


@query("flt_covid", f"SELECT bell_id, ({_YEAR}) IN ('1998-99', '2019-20') AS covid FROM bell")
def _(t):
    y = F.concat(c("year").cast("string"), F.lit("-"), F.lpad(((c("year") + 1) % 100).cast("string"), 2, "0"))
    return bell(t).select("bell_id", (D.covid_year(y) | (y == "1998-99")).alias("covid"))


@query("flt_ratio_ok", "SELECT district_id, year, coalesce(pupils / nullif(staff, 0) BETWEEN 5 AND 100, false) AS ok FROM facts")
def _(t):
    return facts(t).select("district_id", "year", F.coalesce(F.try_divide("pupils", "staff").between(5, 100), F.lit(False)).alias("ok"))


@query("flt_sped_intensive", "SELECT district_id, year, coalesce(pupils / nullif(staff, 0) < 20, false) AS intensive FROM facts")
def _(t):
    return facts(t).select("district_id", "year", F.coalesce(F.try_divide("pupils", "staff") < 20, F.lit(False)).alias("intensive"))


@query("flt_export", "SELECT district_id, state, enrollment FROM districts WHERE upper(state) IN ('NATION_1', 'NATION_2') AND enrollment BETWEEN 500 AND 9000 ORDER BY enrollment DESC, district_id LIMIT 20")
def _(t):
    d = districts(t).where(F.upper("state").isin("NATION_1", "NATION_2") & c("enrollment").between(500, 9000))
    return d.orderBy(F.desc("enrollment"), "district_id").limit(20).select("district_id", "state", "enrollment")
