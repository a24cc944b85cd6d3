"""Aggregations, and the attention metric's long table that many of them read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import attention as A
from ..operators.relational import latest_per_key, unpivot_present
from .joins import newest
from .model import STAFF, attempts, bell, counts, districts, enrollment, lea_ratios, requirements, staff, state_ratios
from .projections import levels, size_class
from .registry import query, share

c = F.col


def even(staff: str, pupils: str) -> str:
    """SQL for minutes * staff / pupils to 2 places, ties to even, in whole numbers."""
    n, d = f"(minutes * CAST(round({staff} * 100) AS BIGINT))", f"CAST({pupils} AS BIGINT)"
    return f"CASE WHEN {staff} > 0 AND {pupils} > 0 THEN ({n} // {d} + CASE WHEN 2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND ({n} // {d}) % 2 = 1) THEN 1 ELSE 0 END) / 100.0 END"


def _rows_sql(rows: list[tuple[str, str, str, str]], source: str) -> str:
    """One SELECT for each (scope, staff, pupils, kind); kind: plain, level (dropped above 360), cap (cut to 360)."""
    parts = []
    for scope, s, n, kind in rows:
        v = even(s, n)
        shown = f"least({v}, 360.0)" if kind == "cap" else v
        note = f"CASE WHEN ({v}) > 360 THEN 'WARN_SPED_RATIO_CAP' ELSE '' END" if kind == "cap" else "''"
        limit = f" AND minutes * CAST({s} AS DOUBLE) / {n} <= 360" if kind == "level" else ""
        parts.append(f"SELECT district_id, state, minutes, minutes_source, '{scope}' AS scope, CAST({s} AS DOUBLE) AS staff, CAST({n} AS DOUBLE) AS pupils, {shown} AS lct, {note} AS notes FROM {source} WHERE {s} > 0 AND {n} > 0{limit}")
    return " UNION ALL ".join(parts)


BASE_ROWS = [(s, f'"{s}"', "k12", "plain") for s in A.BASE] + [("teachers_elementary", "teachers_k5", "k5", "level"), ("teachers_secondary", "teachers_612", "g612", "level")]
SPED_ROWS = [("core_sped", "sped_teachers", "self_contained", "cap"), ("teachers_gened", "gened_teachers", "(k12 - coalesce(self_contained, 0))", "level"), ("instructional_sped", "sped_instructional", "self_contained", "cap")]
share("lastscopes", "SELECT * FROM scopes QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year DESC) = 1")
share("lastlevels", "SELECT * FROM levels QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year DESC) = 1")
share("lastsped", "SELECT * FROM sped QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year DESC) = 1")
share("lctbase", """
    SELECT d.district_id, d.state, m.minutes, m.minutes_source, s.teachers_only, s.teachers_k5, s.teachers_612, s.teachers_core, s.instructional, s.instructional_plus_support, s."all", l.k12, l.k5, l.g612,
           p.self_contained, p.sped_teachers, p.sped_instructional, p.gened_teachers
    FROM lastscopes s JOIN districts d ON s.district_id = d.district_id AND NOT d.shared_service JOIN lastlevels l ON l.district_id = d.district_id AND l.k12 > 0
    JOIN minuteschain m ON m.district_id = d.district_id LEFT JOIN lastsped p ON p.district_id = d.district_id AND p.confidence <> 'low'""")
share("lctrows", _rows_sql(BASE_ROWS, "lctbase"))
share("lctsped", _rows_sql(BASE_ROWS + SPED_ROWS, "lctbase"))


def latest_scopes(t):
    return latest_per_key(A.with_scopes(staff(t)), ["district_id"], [F.desc("year")]).drop("year", *A_STAFF)


A_STAFF = ("elementary", "secondary", "kindergarten", "ungraded", "paras", "coordinators")


def latest_wide(t):
    """Each district's latest year with staff by category and pupils by level, from one aggregate over the counts."""
    some = lambda col, *k: F.sum(F.when(c(col).isin(*k), c("n")))
    zero = lambda x: F.coalesce(x, F.lit(0)) * 10
    sums = [some("category", k).alias(v) for k, v in STAFF.items()]
    wide = counts(t).groupBy("district_id", "year").agg(*sums, (F.sum("n") * 10).alias("total"), zero(some("grade", "KG", "01", "05")).alias("k5"), zero(some("grade", "06", "08", "09")).alias("g612"), zero(some("grade", "PK")).alias("prek"))
    return latest_per_key(wide, ["district_id"], [F.desc("year")]).withColumn("k12", c("total") - c("prek"))


def lct_rows(t, with_sped=False):
    """The long table: a row for each district and scope."""
    wide = A.with_scopes(latest_wide(t)).where("k12 > 0")
    minutes = A.minutes_chain(bell(t), requirements(t), districts(t))
    joined = wide.join(districts(t).where("not shared_service").select("district_id", "state"), "district_id").join(minutes, "district_id")
    if with_sped:
        z = lambda n: F.coalesce(n, F.lit(0))
        joined = joined.withColumns({"teachers": (z("elementary") + z("secondary") + z("kindergarten")).cast("double"), "pupils": c("total")})
        joined = A.with_special_education(joined, lea_ratios(t), state_ratios(t))
        sure = c("confidence") != "low"
        joined = joined.withColumns({n: F.when(sure, c(n)) for n in ("self_contained", "sped_teachers", "sped_instructional", "gened_teachers")})
    return A.variant_rows(joined.drop("year", "pupils", *A_STAFF), with_sped)


_STATS = "count(*) AS n, round(avg(lct), 8) AS mean, round(median(lct), 8) AS median, round(stddev_samp(lct), 8) AS std, min(lct) AS least, max(lct) AS most, count(DISTINCT district_id) AS districts"


@query("agg_scope_summary", f"SELECT scope, {_STATS} FROM lctrows GROUP BY scope")
def _(t):
    return A.summary(lct_rows(t), "scope")


@query("agg_state_scope", f"SELECT state, scope, {_STATS} FROM lctrows GROUP BY state, scope")
def _(t):
    return A.summary(lct_rows(t), "state", "scope")


_MV = ("teachers_only", "teachers_core", "instructional", "all")


@query("agg_mv_stats", f"""
    WITH u AS (SELECT district_id, scope, 360 * v / pupils AS lct FROM (SELECT s.district_id, l.k12 AS pupils, unnest([{", ".join(f"'{s}'" for s in _MV)}]) AS scope, unnest([{", ".join(f's."{s}"' for s in _MV)}]) AS v
               FROM lastscopes s JOIN lastlevels l ON s.district_id = l.district_id) WHERE v IS NOT NULL AND pupils > 0)
    SELECT scope, count(*) AS n, round(avg(lct), 4) AS mean, round(quantile_cont(lct, 0.5), 4) AS median, round(stddev_samp(lct), 4) AS std, round(min(lct), 4) AS least, round(max(lct), 4) AS most FROM u WHERE lct > 0 AND lct <= 360 GROUP BY scope""")
def _(t):
    wide = A.with_scopes(latest_wide(t)).withColumn("pupils", c("k12")).where("pupils > 0")  # one scan for staff and pupils
    long = unpivot_present(wide, ["district_id", "pupils"], list(_MV), "scope", "v").withColumn("lct", 360 * c("v") / c("pupils")).where("lct > 0 and lct <= 360")
    r = lambda x, n: F.round(x, 4).alias(n)
    return long.groupBy("scope").agg(F.count("*").alias("n"), r(F.avg("lct"), "mean"), r(F.percentile("lct", F.lit(0.5)), "median"), r(F.stddev_samp("lct"), "std"), r(F.min("lct"), "least"), r(F.max("lct"), "most"))


@query("agg_state_progress", """
    SELECT d.state, count(DISTINCT d.district_id) AS districts, count(DISTINCT b.district_id) AS enriched, round(count(DISTINCT b.district_id) * 100.0 / nullif(count(DISTINCT d.district_id), 0), 4) AS percent,
           CAST(sum(d.enrollment) AS BIGINT) AS pupils, CASE WHEN count(DISTINCT b.district_id) >= 40 THEN 'complete' WHEN count(DISTINCT b.district_id) > 0 THEN 'in_progress' ELSE 'not_started' END AS status
    FROM districts d LEFT JOIN bell b ON b.district_id = d.district_id AND b.confidence = 'low' GROUP BY 1""")
def _(t):
    # the sum counts a district once for each of its rows, as the joined rows do
    b = bell(t).where("confidence = 'low'").groupBy("district_id").agg(F.count("*").alias("rows"))
    g = districts(t).join(b, "district_id", "left").groupBy("state").agg(F.count("*").alias("districts"), F.count("rows").alias("enriched"), F.sum(c("enrollment") * F.coalesce("rows", F.lit(1))).alias("pupils"))
    status = F.when(c("enriched") >= 40, "complete").when(c("enriched") > 0, "in_progress").otherwise("not_started")
    return g.select("state", "districts", "enriched", F.round(c("enriched") * 100.0 / c("districts"), 4).alias("percent"), "pupils", status.alias("status"))


@query("agg_count_by_group", "SELECT d.district_id, d.name, count(b.bell_id) AS n FROM districts d JOIN bell b ON b.district_id = d.district_id AND b.year = 1998 GROUP BY 1, 2")
def _(t):
    n = bell(t, 1998).groupBy("district_id").agg(F.count("bell_id").alias("n"))
    return districts(t).join(n, "district_id").select("district_id", "name", "n")


@query("agg_enrich_state", "SELECT state, count(DISTINCT d.district_id) AS districts, count(DISTINCT b.district_id) AS enriched, round(count(DISTINCT b.district_id) * 100.0 / count(DISTINCT d.district_id), 4) AS percent FROM districts d LEFT JOIN bell b ON b.district_id = d.district_id AND b.year = 1999 GROUP BY 1")
def _(t):
    b = bell(t, 1999).select("district_id").distinct().withColumn("has", F.lit(1))
    g = districts(t).join(b, "district_id", "left").groupBy("state").agg(F.count("*").alias("districts"), F.count("has").alias("enriched"))
    return g.withColumn("percent", F.round(c("enriched") * 100.0 / c("districts"), 4))


@query("agg_campaign", """
    SELECT state, count(DISTINCT b.district_id) AS enriched, CAST(sum(enrollment) AS BIGINT) AS pupils, 3 AS target, count(DISTINCT b.district_id) >= 3 AS complete
    FROM districts d JOIN bell b ON b.district_id = d.district_id AND b.year = 1997 AND b.grade_level = 'high' GROUP BY 1 ORDER BY enriched DESC, state""")
def _(t):
    n = bell(t, 1997).where("grade_level = 'high'").groupBy("district_id").agg(F.count("*").alias("rows"))
    g = districts(t).join(n, "district_id").groupBy("state").agg(F.count("*").alias("enriched"), F.sum(c("enrollment") * c("rows")).alias("pupils"))
    return g.select("state", "enriched", "pupils", F.lit(3).alias("target"), (c("enriched") >= 3).alias("complete")).orderBy(F.desc("enriched"), "state")


@query("agg_size_dist", """
    SELECT CASE WHEN enrollment > 8000 THEN 'Large' WHEN enrollment >= 1000 THEN 'Medium' ELSE 'Small' END AS size, count(*) AS districts, count(b.district_id) AS enriched, round(count(b.district_id) * 100.0 / count(*), 4) AS percent
    FROM districts d LEFT JOIN (SELECT DISTINCT district_id FROM bell WHERE year = 1996) b ON b.district_id = d.district_id GROUP BY 1""")
def _(t):
    b = bell(t, 1996).select("district_id").distinct().withColumn("has", F.lit(1))
    g = districts(t).join(b, "district_id", "left").groupBy(size_class(c("enrollment")).alias("size")).agg(F.count("*").alias("districts"), F.count("has").alias("enriched"))
    return g.withColumn("percent", F.round(c("enriched") * 100.0 / c("districts"), 4))


@query("agg_scalars", """
    SELECT (SELECT count(*) FROM districts) AS districts, (SELECT count(DISTINCT district_id) FROM bell) AS enriched, (SELECT count(*) FROM bell) AS schedules, (SELECT count(DISTINCT state) FROM districts) AS states,
           (SELECT string_agg(method || '=' || n, ',' ORDER BY method) FROM (SELECT method, count(*) AS n FROM bell GROUP BY 1)) AS methods""")
def _(t):
    m = bell(t).groupBy("method", "district_id").agg(F.count("*").alias("n"))
    per = m.groupBy("method").agg(F.sum("n").alias("n"))
    methods = per.agg(F.sum("n").alias("schedules"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("method", "n"))), lambda x: F.concat(x["method"], F.lit("="), x["n"].cast("string"))), ",").alias("methods"))
    d = districts(t).agg(F.count("*").alias("districts"), F.countDistinct("state").alias("states"))
    return d.crossJoin(bell(t).agg(F.countDistinct("district_id").alias("enriched"))).crossJoin(methods)  # one row each


@query("agg_scope_count", 'SELECT year, count(*) FILTER (instructional > 0) AS with_scope, count(*) AS n FROM scopes GROUP BY 1')
def _(t):
    return A.with_scopes(staff(t)).groupBy("year").agg(F.count_if(c("instructional") > 0).alias("with_scope"), F.count("*").alias("n"))


@query("agg_view_enriched", "SELECT district_id, count(DISTINCT grade_level) AS levels, max(confidence) AS confidence, max(method) AS method FROM bell GROUP BY 1")
def _(t):
    return bell(t).groupBy("district_id").agg(F.countDistinct("grade_level").alias("levels"), F.max("confidence").alias("confidence"), F.max("method").alias("method"))


@query("agg_attempts", "SELECT status, block_type, count(*) AS n, count(DISTINCT district_id) AS districts, round(avg(timing), 4) AS mean, min(timing) AS least, max(timing) AS most FROM attempts GROUP BY 1, 2")
def _(t):
    return attempts(t).groupBy("status", "block_type").agg(F.count("*").alias("n"), F.countDistinct("district_id").alias("districts"), F.round(F.avg("timing"), 4).alias("mean"), F.min("timing").alias("least"), F.max("timing").alias("most"))


SKIPS = "SELECT district_id, max(attempted) AS last, count(*) AS n, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses, bool_or(skip) AS skip FROM attempts GROUP BY 1 HAVING bool_or(skip)"


def skips(t):
    g = attempts(t).groupBy("district_id").agg(F.max("attempted").alias("last"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("status")), ",").alias("statuses"), F.bool_or("skip").alias("skip"))
    return g.where("skip")


@query("agg_skip_view", SKIPS)
def _(t):
    return skips(t)


@query("agg_filter_clause", "SELECT block_type, count(*) FILTER (status = 'blocked') AS blocked, count(*) FILTER (status = 'success') AS success, round(avg(timing), 4) AS mean, round(CAST(sum(timing) AS BIGINT) / 100.0, 4) AS cost FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy("block_type").agg(F.count_if(c("status") == "blocked").alias("blocked"), F.count_if(c("status") == "success").alias("success"), F.round(F.avg("timing"), 4).alias("mean"), F.round(F.sum("timing").cast("double") / 100, 4).alias("cost"))


@query("agg_tier_success", "SELECT k % 5 + 1 AS tier, count(*) AS n, round(count(*) FILTER (status = 'success') * 100.0 / count(*), 4) AS percent FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy((c("k") % 5 + 1).alias("tier")).agg(F.count("*").alias("n"), F.round(F.count_if(c("status") == "success") * 100.0 / F.count("*"), 4).alias("percent"))


@query("agg_batch_summary", "SELECT k AS batch, count(*) AS n, CAST(sum(timing) AS BIGINT) AS cost, round(CAST(sum(timing) AS BIGINT) * 1.0 / nullif(count(*) FILTER (status = 'success'), 0), 4) AS cost_each FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy(c("k").alias("batch")).agg(F.count("*").alias("n"), F.sum("timing").alias("cost"), F.round(F.try_divide(F.sum("timing").cast("double"), F.count_if(c("status") == "success")), 4).alias("cost_each"))


_METRICS = ("total", "success", "blocked", "timeout", "not_found", "districts", "skipped", "first_day", "last_day", "mean_timing")


@query("agg_dashboard", """
    WITH a AS (SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'blocked') AS blocked, count(*) FILTER (status = 'timeout') AS timeout, count(*) FILTER (status = 'not_found') AS not_found,
               count(DISTINCT district_id) AS districts, count(*) FILTER (skip) AS skipped, CAST(CAST(min(attempted) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(attempted) AS DATE) AS VARCHAR) AS last_day, CAST(CAST(sum(timing) AS BIGINT) // count(*) AS BIGINT) AS mean_timing FROM attempts)
    """ + " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS VARCHAR) AS value FROM a" for m in _METRICS))
def _(t):
    return dashboard(attempts(t))


def dashboard(a):
    """(metric, value) rows, all from one aggregate."""
    n = lambda s: F.count_if(c("status") == s).alias(s)
    one = a.agg(F.count("*").alias("total"), *map(n, ("success", "blocked", "timeout", "not_found")), F.countDistinct("district_id").alias("districts"), F.count_if("skip").alias("skipped"), F.to_date(F.min("attempted")).alias("first_day"), F.to_date(F.max("attempted")).alias("last_day"), F.floor(F.sum("timing") / F.count("*")).alias("mean_timing"))
    return one.select(*[c(m).cast("string").alias(m) for m in _METRICS]).unpivot([], list(_METRICS), "metric", "value")


@query("agg_having", "SELECT district_id, count(*) AS n FROM attempts WHERE status = 'blocked' GROUP BY 1 HAVING count(*) >= 3")
def _(t):
    return attempts(t).where("status = 'blocked'").groupBy("district_id").agg(F.count("*").alias("n")).where("n >= 3")


@query("agg_date", "SELECT CAST(CAST(attempted AS DATE) AS VARCHAR) AS day, count(*) AS n FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy(F.to_date("attempted").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("agg_state_avg_trim", "SELECT state, round(avg(CAST(prek AS DOUBLE) / total), 4) AS share, count(*) AS n FROM newest e JOIN districts d ON e.district_id = d.district_id WHERE CAST(prek AS DOUBLE) / total > 0 AND CAST(prek AS DOUBLE) / total < 0.5 GROUP BY 1")
def _(t):
    e = newest(t).withColumn("p", c("prek") / c("total")).where("p > 0 and p < 0.5")
    return e.join(districts(t), "district_id").groupBy("state").agg(F.round(F.avg("p"), 4).alias("share"), F.count("*").alias("n"))


@query("agg_national_avg", "SELECT round(avg(CAST(nullif(paras, 0) AS DOUBLE) / nullif(elementary, 0)), 4) AS paras, round(avg(CAST(nullif(coordinators, 0) AS DOUBLE) / nullif(paras, 0)), 4) AS coordinators FROM staff WHERE nullif(elementary, 0) IS NOT NULL")
def _(t):
    s = staff(t).where("nullif(elementary, 0) is not null")
    r = lambda a, b: F.round(F.avg(F.try_divide(N.truthy(c(a)), N.truthy(c(b)))), 4)
    return s.agg(r("paras", "elementary").alias("paras"), r("coordinators", "paras").alias("coordinators"))


@query("agg_state_env", "SELECT d.state, nullif(CAST(coalesce(sum(n) FILTER (category IN ('AF', 'RF')), 0) AS BIGINT), 0) AS mainstreamed, nullif(CAST(coalesce(sum(n) FILTER (category IN ('NO', 'NF')), 0) AS BIGINT), 0) AS self_contained FROM counts s JOIN districts d ON s.district_id = d.district_id GROUP BY 1")
def _(t):
    some = lambda *k: F.nullif(F.coalesce(F.sum(F.when(c("category").isin(*k), c("n"))), F.lit(0)), F.lit(0))
    return counts(t).join(districts(t).select("district_id", "state"), "district_id").groupBy("state").agg(some("AF", "RF").alias("mainstreamed"), some("NO", "NF").alias("self_contained"))


@query("agg_lea_sum", "SELECT district_id, nullif(CAST(sum(n) FILTER (source = 'federal') AS BIGINT), 0) AS male, nullif(CAST(sum(n) FILTER (source = 'state') AS BIGINT), 0) AS female FROM counts GROUP BY 1")
def _(t):
    some = lambda s: F.nullif(F.sum(F.when(c("source") == s, c("n"))), F.lit(0))
    return counts(t).groupBy("district_id").agg(some("federal").alias("male"), some("state").alias("female"))


@query("agg_pair_teachers_paras", "SELECT district_id, year, coalesce(elementary, 0) + coalesce(paras, 0) AS both FROM staff WHERE coalesce(elementary, 0) > 0 OR coalesce(paras, 0) > 0")
def _(t):
    s = staff(t).where("coalesce(elementary, 0) > 0 or coalesce(paras, 0) > 0")
    return s.select("district_id", "year", (F.coalesce("elementary", F.lit(0)) + F.coalesce("paras", F.lit(0))).alias("both"))


@query("agg_ca_sum", "SELECT l_suppkey, CAST(sum(coalesce(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE), 0)) AS BIGINT) AS n, min(l_returnflag) AS name FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(F.coalesce(c("l_quantity").cast("string").try_cast("double"), F.lit(0.0))).cast("long").alias("n"), F.min("l_returnflag").alias("name"))


@query("agg_frpm", "SELECT district_id, CAST(sum(n) AS BIGINT) AS pupils, CAST(coalesce(sum(n) FILTER (source = 'state'), 0) AS BIGINT) AS poor, round(coalesce(CAST(sum(n) FILTER (source = 'state') AS DOUBLE) / nullif(CAST(sum(n) AS DOUBLE), 0), 0), 4) AS share FROM counts GROUP BY 1")
def _(t):
    poor = F.sum(F.when(c("source") == "state", c("n")))
    return counts(t).groupBy("district_id").agg(F.sum("n").alias("pupils"), F.coalesce(poor, F.lit(0)).alias("poor"), F.round(F.coalesce(F.try_divide(poor.cast("double"), F.sum("n").cast("double")), F.lit(0.0)), 4).alias("share"))


@query("agg_grade_sum", "SELECT district_id, grade, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY 1, 2")
def _(t):
    return counts(t).groupBy("district_id", "grade").agg(F.sum("n").alias("n"))


@query("agg_two_phase", "SELECT grade, CAST(sum(n) AS BIGINT) AS n, count(*) AS rows FROM counts WHERE category <> 'RO' GROUP BY 1")
def _(t):
    return counts(t).where("category <> 'RO'").groupBy("grade").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))


@query("agg_ny_sum", "SELECT district_id, CAST(sum(n) FILTER (category = 'AF') AS BIGINT) AS teachers, CAST(sum(n) AS BIGINT) AS pupils FROM counts GROUP BY 1")
def _(t):
    return counts(t).groupBy("district_id").agg(F.sum(F.when(c("category") == "AF", c("n"))).alias("teachers"), F.sum("n").alias("pupils"))


@query("agg_compare", """
    SELECT d.state, round(avg(f), 4) AS federal, round(avg(s), 4) AS state_mean, round(avg(s) - avg(f), 4) AS diff, round((avg(s) - avg(f)) * 100 / nullif(avg(f), 0), 4) AS percent
    FROM (SELECT district_id, CAST(sum(n) FILTER (source = 'federal') AS BIGINT) AS f, CAST(sum(n) FILTER (source = 'state') AS BIGINT) AS s FROM counts GROUP BY 1) x JOIN districts d ON x.district_id = d.district_id GROUP BY 1""")
def _(t):
    some = lambda s: F.sum(F.when(c("source") == s, c("n")))
    x = counts(t).groupBy("district_id").agg(some("federal").alias("f"), some("state").alias("s")).join(districts(t).select("district_id", "state"), "district_id")
    f, s = F.avg("f"), F.avg("s")
    return x.groupBy("state").agg(F.round(f, 4).alias("federal"), F.round(s, 4).alias("state_mean"), F.round(s - f, 4).alias("diff"), F.round(F.try_divide((s - f) * 100, f), 4).alias("percent"))


@query("agg_progress", """
    SELECT state, count(*) AS total, count(*) FILTER (enriched) AS done, count(*) - count(*) FILTER (enriched) AS pending, round(count(*) FILTER (enriched) * 100.0 / count(*), 4) AS rate, greatest(70 - count(*) FILTER (enriched), 0) AS needed, count(*) FILTER (enriched) >= 70 AS complete
    FROM (SELECT d.state, b.district_id IS NOT NULL AS enriched FROM districts d LEFT JOIN (SELECT DISTINCT district_id FROM bell WHERE year = 1998) b ON b.district_id = d.district_id) GROUP BY 1""")
def _(t):
    b = bell(t, 1998).select("district_id").distinct().withColumn("has", F.lit(1))
    g = districts(t).join(b, "district_id", "left").groupBy("state").agg(F.count("*").alias("total"), F.count("has").alias("done"))
    return g.withColumns({"pending": c("total") - c("done"), "rate": F.round(c("done") * 100.0 / c("total"), 4), "needed": F.greatest(70 - c("done"), F.lit(0)), "complete": c("done") >= 70})


@query("agg_nunique", "SELECT count(DISTINCT district_id) AS districts, count(DISTINCT block_type) AS kinds FROM attempts WHERE skip")
def _(t):
    return attempts(t).where("skip").agg(F.countDistinct("district_id").alias("districts"), F.countDistinct("block_type").alias("kinds"))


@query("agg_flag_counts", "SELECT count(*) FILTER (contains(status, 'block')) AS block, count(*) FILTER (contains(status, 'time')) AS time, count(*) FILTER (contains(status, 'found')) AS found FROM attempts")
def _(t):
    return attempts(t).agg(*[F.count_if(c("status").contains(w)).alias(n) for n, w in (("block", "block"), ("time", "time"), ("found", "found"))])


@query("agg_year_minmax", "SELECT min(year || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0')) AS first, arg_max(year || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0'), year) AS last FROM enrollment WHERE year > 1990")
def _(t):
    y = F.concat(c("year").cast("string"), F.lit("-"), F.lpad(((c("year") + 1) % 100).cast("string"), 2, "0"))
    return enrollment(t).where("year > 1990").select("year").distinct().agg(F.min_by(y, "year").alias("first"), F.max_by(y, "year").alias("last"))


@query("agg_quartiles", "SELECT state, l[len(l) // 4 + 1] AS q1, l[len(l) * 3 // 4 + 1] AS q3 FROM (SELECT state, list(enrollment ORDER BY enrollment) AS l FROM districts GROUP BY 1)")
def _(t):
    from pyspark.sql import Window

    # the two places are picked by rank, so no state's values meet in one array
    w = Window.partitionBy("state")
    d = districts(t).withColumns({"i": F.row_number().over(w.orderBy("enrollment")) - 1, "n": F.count("*").over(w)})
    at = lambda k: F.max(F.when(c("i") == F.floor(c("n") * k / 4), c("enrollment")))
    return d.groupBy("state").agg(at(1).alias("q1"), at(3).alias("q3"))


@query("agg_lcff", "SELECT year, CAST(sum(paras) AS BIGINT) AS total, round(avg(paras), 4) AS mean, round(avg(CAST(paras AS DOUBLE) / nullif(paras + elementary, 0)), 4) AS share FROM staff GROUP BY 1")
def _(t):
    return staff(t).groupBy("year").agg(F.sum("paras").alias("total"), F.round(F.avg("paras"), 4).alias("mean"), F.round(F.avg(F.try_divide(c("paras").cast("double"), (c("paras") + c("elementary")).cast("double"))), 4).alias("share"))


@query("agg_batch_stats", "SELECT segment, min(n) AS least, max(n) AS most, round(avg(n), 4) AS mean, median(n) AS median, CAST(sum(n) AS BIGINT) AS total FROM (SELECT segment, state, count(*) AS n FROM districts GROUP BY 1, 2) GROUP BY 1")
def _(t):
    n = districts(t).groupBy("segment", "state").agg(F.count("*").alias("n"))
    return n.groupBy("segment").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 4).alias("mean"), F.median("n").alias("median"), F.sum("n").alias("total"))


@query("agg_mode_share", "SELECT CASE WHEN max(n) * 1.0 / sum(n) > 0.5 THEN 'targeted' ELSE 'general' END AS strategy, round(max(n) * 1.0 / sum(n), 4) AS share FROM (SELECT block_type, count(*) AS n FROM attempts GROUP BY 1)")
def _(t):
    n = attempts(t).groupBy("block_type").agg(F.count("*").alias("n")).agg((F.max("n") / F.sum("n")).alias("s"))
    return n.select(F.when(c("s") > 0.5, "targeted").otherwise("general").alias("strategy"), F.round("s", 4).alias("share"))


@query("agg_value_counts", "SELECT state, count(*) AS n FROM districts GROUP BY 1 ORDER BY n DESC, state LIMIT 10")
def _(t):
    return districts(t).groupBy("state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "state").limit(10)


@query("agg_pass_rate", """
    SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN status = 'blocked' THEN 'blocked' END, CASE WHEN timing > 9000 THEN 'slow' END, CASE WHEN skip THEN 'skipped' END], lambda x: x IS NOT NULL)) AS flag FROM attempts) GROUP BY 1 ORDER BY n DESC, flag LIMIT 5""")
def _(t):
    f = F.array_compact(F.array(F.when(c("status") == "blocked", "blocked"), F.when(c("timing") > 9000, "slow"), F.when(c("skip"), "skipped")))
    return attempts(t).select(F.explode(f).alias("flag")).groupBy("flag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "flag").limit(5)


@query("agg_distinct_count", "SELECT DISTINCT state FROM districts ORDER BY state")
def _(t):
    return districts(t).select("state").distinct().orderBy("state")
