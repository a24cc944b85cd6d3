"""Data-quality rules and reports, and the flagship calculation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import attention as A
from ..operators import quality as D
from ..operators.relational import absent, latest_per_key
from ..sources.files import stored
from .aggregations import latest_scopes, lct_rows
from .joins import newest
from .model import attempts, bell, counts, districts, enrollment, requirements
from .projections import facts, levels, sped
from .registry import query, share

c = F.col


def joined(*cases: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in cases) + ")"


_L = 'm.minutes * s.teachers_k5 / nullif(l.k5, 0)', 'm.minutes * s.teachers_612 / nullif(l.g612, 0)'
_LEVEL_CASES = joined(
    ("elementary_over", f"{_L[0]} > 360"), ("secondary_over", f"{_L[1]} > 360"), ("elementary_no_pupils", "s.teachers_k5 > 0 AND coalesce(l.k5, 0) <= 0"), ("secondary_no_pupils", "s.teachers_612 > 0 AND coalesce(l.g612, 0) <= 0"),
    ("elementary_no_staff", "l.k5 > 0 AND coalesce(s.teachers_k5, 0) <= 0"), ("secondary_no_staff", "l.g612 > 0 AND coalesce(s.teachers_612, 0) <= 0"), ("sum_mismatch", "NOT coalesce(CAST(l.k5 + l.g612 AS DOUBLE), 0) / nullif(l.k12, 0) BETWEEN 0.8 AND 1.2"),
)


@query("dq_level", f"SELECT s.district_id, {_LEVEL_CASES} AS notes FROM lastscopes s JOIN lastlevels l ON s.district_id = l.district_id JOIN minuteschain m ON m.district_id = s.district_id")
def _(t):
    l = latest_per_key(levels(t), ["district_id"], [F.desc("year")]).drop("year")  # noqa: E741
    x = latest_scopes(t).join(l, "district_id").join(A.minutes_chain(bell(t), requirements(t), districts(t)), "district_id")
    v = lambda s, n: F.try_divide(c("minutes") * c(s), F.nullif(n, F.lit(0)))
    notes = D.level_notes(v("teachers_k5", "k5"), v("teachers_612", "g612"), c("teachers_k5"), c("teachers_612"), c("k5"), c("g612"), c("k12"))
    return x.select("district_id", F.concat_ws(",", notes).alias("notes"))


_BASE = "(" + ", ".join(f"'{s}'" for s in A.BASE) + ")"
share("flagged", f"""
    SELECT r.district_id, r.state, r.scope, r.lct, concat_ws('; ', nullif(r.notes, ''), {joined(
        ("ERR_FLAT_STAFF", "r.scope = b.scope AND b.n >= 5 AND b.kinds = 1"), ("ERR_IMPOSSIBLE_SSR", "r.scope = b.scope AND r.staff / r.pupils > 0.5"),
        ("ERR_RATIO_CEILING", "r.scope = b.scope AND b.n >= 5 AND b.t > 0 AND b.a > 0 AND abs(b.t - b.a) < 0.01"), ("ERR_VOLATILE", "r.scope = b.scope AND r.pupils < 50 AND r.pupils <> 0"),
        ("WARN_LCT_HIGH", "r.scope = 'teachers_only' AND r.lct > 120"), ("WARN_LCT_LOW", "r.lct < 5 AND r.lct <> 0")).replace("concat_ws(',',", "nullif(concat_ws('; ',") + ", '')"}) AS notes
    FROM lctsped r LEFT JOIN (
        SELECT district_id, unnest([{_BASE[1:-1]}]) AS scope, n, kinds, t, a
        FROM (SELECT district_id, count(*) AS n, count(DISTINCT staff) AS kinds, max(staff) FILTER (scope = 'teachers_only') AS t, max(staff) FILTER (scope = 'all') AS a FROM lctsped WHERE scope IN {_BASE} GROUP BY 1)) b
      ON b.district_id = r.district_id AND b.scope = r.scope""")


def flagged(t):
    return D.safeguards(lct_rows(t, with_sped=True))


@query("dq_safeguards", "SELECT district_id, scope, lct, notes FROM flagged")
def _(t):
    return flagged(t).select("district_id", "scope", "lct", "notes")


_QA_FIGURES = " UNION ALL ".join(f"SELECT 'scope_summary', scope || '.{x}', CAST({x} AS DOUBLE), NULL FROM by_scope" for x in ("districts", "mean", "median", "min", "max"))
_QA_PAIRS = ", ".join(f"('{name}', '{a}', '{b}')" for name, (a, b) in D.ORDERED.items())
_QA = f"""
    WITH f AS MATERIALIZED (SELECT * FROM flagged), v AS (SELECT * FROM f WHERE lct > 0 AND lct <= 360),
    by_scope AS MATERIALIZED (SELECT scope, count(DISTINCT district_id) AS districts, round(avg(lct), 2) AS mean, round(median(lct), 2) AS median, round(min(lct), 2) AS min, round(max(lct), 2) AS max FROM v GROUP BY 1),
    pairs AS (SELECT p.name, a.mean < b.mean AS ok FROM (VALUES {_QA_PAIRS}) p(name, lesser, greater) JOIN by_scope a ON a.scope = p.lesser JOIN by_scope b ON b.scope = p.greater),
    odd AS (SELECT scope, district_id, lct, lct < 5 AS low, row_number() OVER (PARTITION BY scope, lct < 5 ORDER BY district_id) AS place FROM v WHERE lct < 5 OR lct > 200),
    shown AS (SELECT * FROM odd WHERE place <= 5 ORDER BY list_position([{", ".join(f"'{s}'" for s in D.SCOPE_ORDER)}], scope), low DESC, place LIMIT 20)
    SELECT 'data_quality' AS section, 'total_calculations' AS name, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM f
    UNION ALL SELECT 'data_quality', 'valid_calculations', count(*), NULL FROM v
    UNION ALL SELECT 'data_quality', 'invalid_calculations', (SELECT count(*) FROM f) - count(*), NULL FROM v
    UNION ALL SELECT 'data_quality', 'pass_rate', round((SELECT count(*) FROM v) * 100 / count(*), 2), NULL FROM f
    UNION ALL SELECT 'data_quality', 'districts_with_qa_notes', count(DISTINCT district_id), NULL FROM f WHERE notes <> ''
    UNION ALL SELECT 'safeguards', flag, (SELECT count(*) FROM f WHERE contains(notes, flag)), NULL FROM (SELECT unnest([{", ".join(f"'{x}'" for x in D.FLAGS)}]) AS flag)
    UNION ALL SELECT 'state_coverage', 'states_with_data', count(DISTINCT state), NULL FROM v
    UNION ALL {_QA_FIGURES}
    UNION ALL SELECT 'hierarchy', name, CAST(ok AS INTEGER), NULL FROM pairs
    UNION ALL SELECT 'overall_status', 'overall_status', CAST(bool_and(ok) AS INTEGER), CASE WHEN bool_and(ok) THEN 'PASS' ELSE 'WARNING' END FROM pairs
    UNION ALL SELECT 'outliers', scope || '.' || district_id, lct, CASE WHEN low THEN 'Very low LCT: ' ELSE 'Very high LCT: ' END || printf('%.1f', round_even(lct, 1)) || CASE WHEN low THEN ' min (warning)' ELSE ' min (info)' END FROM shown"""


@query("dq_qa_report", _QA)
def _(t):
    # the calculation is stored once, as every run's is, and each part of the report reads what it needs of it
    return D.qa_report(stored(flagged(t).select("district_id", "state", "scope", "lct", "notes"), "run"))


_SCHEDULES = [("8:00 AM", "3:00 PM", 400, "high"), ("5:00 AM", "3:00 PM", 400, "high"), ("8:00", "3:00 PM", 400, "middle"), ("3:00 PM", "8:00 AM", 300, "elementary"), ("8:00 AM", "2:00 PM", 250, "k8"), ("8:00 AM", "2:00 PM", 470, "high"), (None, None, None, None), ("9:00 AM", "6:30 PM", 380, "high")]
_SVALUES = ", ".join("(" + str(i) + ", " + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for i, r in enumerate(_SCHEDULES))
_CLOCK = "CASE WHEN regexp_matches({0}, '(?i)^\\s*\\d{{1,2}}:\\d{{2}}\\s*(AM|PM)\\s*$') THEN (CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) % 12 + CASE WHEN upper({0}) LIKE '%PM%' THEN 12 ELSE 0 END) * 60 + CAST(regexp_extract({0}, ':(\\d{{2}})', 1) AS INTEGER) END"
share("schedules", f"SELECT id, a, b, CAST(minutes AS INTEGER) AS minutes, grade, {_CLOCK.format('s')} AS x, {_CLOCK.format('e')} AS y FROM (SELECT id, CAST(s AS VARCHAR) AS s, CAST(e AS VARCHAR) AS e, CAST(s AS VARCHAR) AS a, CAST(e AS VARCHAR) AS b, minutes, grade FROM (VALUES {_SVALUES}) v(id, s, e, minutes, grade))")
_ERRORS = joined(("bad_start", "x IS NULL"), ("bad_end", "y IS NULL"), ("bad_grade", "NOT coalesce(grade IN ('elementary', 'middle', 'high'), false)"), ("order", "y <= x"), ("minutes_range", "minutes NOT BETWEEN 300 AND 480"), ("minutes_over_duration", "minutes > y - x"))
_WARN = joined(("early_or_late_start", "x NOT BETWEEN 360 AND 630"), ("early_or_late_end", "y NOT BETWEEN 840 AND 1050"), ("minutes_far_below", "minutes < y - x - 90"))


def schedules(t):
    s = t.values("id int, s string, e string, minutes int, grade string", *[(i, *r) for i, r in enumerate(_SCHEDULES)])
    errors, warnings = D.schedule_errors(c("s"), c("e"), c("minutes"), c("grade"))
    return s.select("id", F.concat_ws(",", errors).alias("errors"), F.concat_ws(",", warnings).alias("warnings"))


@query("dq_plausible", f"SELECT id, {_ERRORS} AS errors, {_WARN} AS warnings FROM schedules")
def _(t):
    return schedules(t)


@query("dq_plausible_batch", f"SELECT count(*) AS n, count(*) FILTER (errors = '') AS valid, count(*) FILTER (errors <> '') AS invalid, count(*) FILTER (warnings <> '') AS warned FROM (SELECT {_ERRORS} AS errors, {_WARN} AS warnings FROM schedules)")
def _(t):
    return schedules(t).agg(F.count("*").alias("n"), F.count_if(c("errors") == "").alias("valid"), F.count_if(c("errors") != "").alias("invalid"), F.count_if(c("warnings") != "").alias("warned"))


@query("dq_normalized", "SELECT 'district_id' AS \"column\", count(*) FILTER (district_id IS NULL) AS nulls, CAST(0 AS BIGINT) AS negatives FROM districts UNION ALL SELECT 'enrollment', count(*) FILTER (enrollment IS NULL), count(*) FILTER (enrollment < 0) FROM districts")
def _(t):
    return D.column_report(districts(t), ["district_id", "enrollment", "absent"], ["enrollment"])


@query("dq_required", "SELECT unnest(['website', 'zip']) AS missing")
def _(t):
    return t.values("missing string", *[(m,) for m in D.missing_columns(districts(t), ["district_id", "website", "zip"])])


share("bellfile", """
    SELECT b.bell_id, CASE WHEN b.bell_id % 23 = 0 THEN NULL WHEN b.bell_id % 29 = 0 THEN 'Nowhere' ELSE d.state END AS state, CASE WHEN b.bell_id % 31 <> 0 THEN b.year END AS year, CASE WHEN b.bell_id % 7 <> 0 THEN b.bell_id % 5 <> 0 END AS enriched,
           b.grade_level, CASE WHEN b.bell_id % 37 <> 0 THEN b.minutes END AS minutes, CASE b.bell_id % 6 WHEN 0 THEN '8:05 AM' WHEN 1 THEN '8:05' WHEN 2 THEN '805 AM' WHEN 3 THEN '' WHEN 4 THEN '8:05 am' END AS start_time,
           CASE WHEN b.bell_id % 4 = 0 THEN '3:00 PM PM' ELSE '3:00 PM' END AS end_time, CASE WHEN b.confidence = 'low' AND b.bell_id % 2 = 0 THEN 'sure' ELSE b.confidence END AS confidence, b.method, CASE WHEN b.bell_id % 3 <> 0 THEN 'site' END AS source
    FROM bell b JOIN districts d ON d.district_id = b.district_id""")


def bell_file(t):
    """Collected schedules as a file has them, with a share of each kind of fault."""
    k, clock = c("bell_id"), F.array(*map(F.lit, ("8:05 AM", "8:05", "805 AM", "", "8:05 am")))
    rows = bell(t).join(districts(t).select("district_id", "state"), "district_id")
    return rows.select(
        "bell_id", F.when(k % 23 == 0, None).when(k % 29 == 0, "Nowhere").otherwise(c("state")).alias("state"), F.when(k % 31 != 0, c("year")).alias("year"), F.when(k % 7 != 0, k % 5 != 0).alias("enriched"),
        "grade_level", F.when(k % 37 != 0, c("minutes")).alias("minutes"), F.try_element_at(clock, (k % 6 + 1).cast("int")).alias("start_time"), F.when(k % 4 == 0, "3:00 PM PM").otherwise("3:00 PM").alias("end_time"),
        F.when((c("confidence") == "low") & (k % 2 == 0), "sure").otherwise(c("confidence")).alias("confidence"), "method", F.when(k % 3 != 0, "site").alias("source"),
    )


_METHODS = ", ".join(f"'{m}'" for m in D.METHODS)
_TIME_OK = "regexp_matches(coalesce({0}, ''), '^[ \\t]*[^ \\t]*:[^ \\t]*[ \\t]+(AM|PM)[ \\t]*$')"
_FILE_ERRORS = joined(("missing_state", "state IS NULL"), ("invalid_state", "state IS NOT NULL AND state NOT IN (SELECT n_name FROM nation)"), ("minutes_too_low", "minutes < 180"), ("minutes_too_high", "minutes > 480"))
_FILE_WARNINGS = joined(
    ("missing_year", "year IS NULL"), ("minutes_missing", "minutes IS NULL"), ("minutes_low", "minutes BETWEEN 180 AND 239"), ("minutes_high", "minutes BETWEEN 421 AND 480"),
    ("bad_start_time", f"start_time <> '' AND NOT {_TIME_OK.format('start_time')}"), ("bad_end_time", f"end_time <> '' AND NOT {_TIME_OK.format('end_time')}"), ("bad_confidence", "confidence NOT IN ('high', 'medium', 'low')"),
    ("bad_method", f"method NOT IN ({_METHODS})"), ("missing_source", "source IS NULL"), ("missing_enriched", "enriched IS NULL"), ("not_enriched", "NOT enriched"),
)


@query("dq_bell_file", f"SELECT bell_id, {_FILE_ERRORS} AS errors, {_FILE_WARNINGS} AS warnings FROM bellfile")
def _(t):
    errors, warnings = D.bell_file_checks([r["n_name"] for r in t.nation.select("n_name").collect()])  # the states are a fixed list
    return bell_file(t).select("bell_id", F.concat_ws(",", errors).alias("errors"), F.concat_ws(",", warnings).alias("warnings"))


_TABLES = {"nation": 25, "customer": 100, "orders": 1000, "supplier": 1_000_000}


@query("dq_counts", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, count(*) >= {m} AS ok FROM {n}" for n, m in _TABLES.items()))
def _(t):
    rows = [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n", (c("n") >= m).alias("ok")) for n, m in _TABLES.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


_CLAIMS = [("NATION_1", 60), ("NATION_2", 3), ("NATION_404", 5)]


@query("dq_claims", "SELECT v.state, claimed, coalesce(n, 0) AS actual, coalesce(n, 0) BETWEEN greatest(CAST(trunc(claimed - 1.96 * sqrt(claimed)) AS BIGINT), 0) AND CAST(ceil(claimed + 1.96 * sqrt(claimed)) AS BIGINT) AS ok FROM (VALUES " + ", ".join(map(str, _CLAIMS)) + ") v(state, claimed) LEFT JOIN (SELECT state, count(*) AS n FROM districts GROUP BY 1) d ON d.state = v.state")
def _(t):
    from ..functions.numbers import count_interval

    n = districts(t).groupBy("state").agg(F.count("*").alias("n"))
    low, high = count_interval(c("claimed"))
    x = t.values("state string, claimed int", *_CLAIMS).join(n, "state", "left").withColumn("actual", F.coalesce("n", F.lit(0)))
    return x.select("state", "claimed", "actual", c("actual").between(low, high).alias("ok"))


@query("dq_handoff", "SELECT CAST(created AS VARCHAR) AS day, count(*) AS schedules, count(DISTINCT district_id) AS districts FROM bell GROUP BY 1")
def _(t):
    return bell(t).groupBy(c("created").cast("string").alias("day")).agg(F.count("*").alias("schedules"), F.countDistinct("district_id").alias("districts"))


@query("dq_audit", "SELECT total, logged, round(CASE WHEN total = 0 THEN 1.0 ELSE logged * 1.0 / total END, 6) AS completeness FROM (SELECT (SELECT count(*) FROM bell) AS total, (SELECT count(DISTINCT bell_id) FROM bell WHERE confidence <> 'low') AS logged)")
def _(t):
    x = bell(t).agg(F.count("*").alias("total"), F.countDistinct(F.when(c("confidence") != "low", c("bell_id"))).alias("logged"))
    return x.withColumn("completeness", F.round(F.when(c("total") == 0, 1.0).otherwise(c("logged") / c("total")), 6))


@query("dq_lineage_gap", "SELECT bell_id FROM bell WHERE bell_id NOT IN (SELECT bell_id FROM bell WHERE method = 'pdf_text' OR confidence = 'high')")
def _(t):
    return absent(bell(t), bell(t).where("method = 'pdf_text' or confidence = 'high'"), ["bell_id"]).select("bell_id")


@query("dq_integrity", "SELECT 'low_confidence' AS violation, count(*) AS n, CASE WHEN count(*) = 0 THEN 'PASS' WHEN count(*) < 10 THEN 'WARNING' ELSE 'FAIL' END AS status FROM bell WHERE confidence = 'low' UNION ALL SELECT 'no_minutes', count(*), CASE WHEN count(*) = 0 THEN 'PASS' WHEN count(*) < 10 THEN 'WARNING' ELSE 'FAIL' END FROM bell WHERE minutes = 0")
def _(t):
    one = bell(t).agg(F.count_if(c("confidence") == "low").alias("low_confidence"), F.count_if(c("minutes") == 0).alias("no_minutes"))
    return one.unpivot([], ["low_confidence", "no_minutes"], "violation", "n").withColumn("status", F.when(c("n") == 0, "PASS").when(c("n") < 10, "WARNING").otherwise("FAIL"))


@query("dq_override", "SELECT attempt_id, row_number() OVER (PARTITION BY district_id ORDER BY attempted, attempt_id) AS place, row_number() OVER (PARTITION BY district_id ORDER BY attempted, attempt_id) >= 5 AS alert FROM attempts WHERE status IN ('blocked', 'timeout')")
def _(t):
    place = F.row_number().over(Window.partitionBy("district_id").orderBy("attempted", "attempt_id"))
    return attempts(t).where(c("status").isin("blocked", "timeout")).select("attempt_id", place.cast("long").alias("place"), (place >= 5).alias("alert"))


@query("dq_enrollment", "SELECT district_id, year, " + joined(("negative", "total < 0"), ("zero", "total = 0"), ("extreme", "total > 2000000"), ("k12_over_total", "k12 > total"), ("parts_differ", "k5 + g612 <> total")) + " AS notes FROM enrollment JOIN levels USING (district_id, year)")
def _(t):
    x = enrollment(t).join(levels(t), ["district_id", "year"])
    return x.select("district_id", "year", F.concat_ws(",", D.enrollment_notes(c("total"), c("k12"), c("k5") + c("g612"))).alias("notes"))


@query("dq_minutes", "SELECT bell_id, CASE WHEN minutes IS NULL THEN 'missing' WHEN minutes = 0 THEN 'zero' WHEN minutes < 120 THEN 'too_low' WHEN minutes > 540 THEN 'too_high' WHEN minutes = 360 THEN 'default' ELSE 'ok' END AS class FROM bell")
def _(t):
    return bell(t).select("bell_id", D.minutes_class(c("minutes")).alias("class"))


@query("dq_lct_range", "SELECT class, count(*) AS n FROM (SELECT CASE WHEN lct < 0 THEN 'negative' WHEN lct < 1 THEN 'too_low' WHEN lct > 360 AND NOT contains(scope, 'sped') THEN 'too_high' WHEN lct > 360 THEN 'sped_capped' ELSE 'ok' END AS class FROM lctsped) GROUP BY 1")
def _(t):
    return lct_rows(t, True).groupBy(D.value_class(c("lct"), c("scope").contains("sped")).alias("class")).agg(F.count("*").alias("n"))


@query("dq_ca_report", "SELECT round(count(e.district_id) * 100.0 / count(*), 4) AS coverage, round(avg(abs(e.prek - p.sped)), 4) AS difference FROM lastsped p LEFT JOIN newest e ON e.district_id = p.district_id AND e.prek IS NOT NULL")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).select("district_id", "sped")
    x = p.join(newest(t).where("prek is not null").select("district_id", "prek"), "district_id", "left")
    return x.agg(F.round(F.count("prek") * 100.0 / F.count("*"), 4).alias("coverage"), F.round(F.avg(F.abs(c("prek") - c("sped"))), 4).alias("difference"))


@query("dq_ca_sped", "SELECT district_id, sped FROM lastsped WHERE confidence <> 'low' ORDER BY sped DESC, district_id LIMIT 5")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).where("confidence <> 'low'")
    return p.select("district_id", "sped").orderBy(F.desc("sped"), "district_id").limit(5)


@query("dq_precedence", "SELECT district_id, year, source, CAST(n AS BIGINT) AS n FROM (SELECT district_id, year, source, sum(n) AS n FROM counts GROUP BY 1, 2, 3) QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year = 1998 DESC, source = 'federal' DESC, year DESC) = 1")
def _(t):
    return D.preferred_source(counts(t).groupBy("district_id", "year", "source").agg(F.sum("n").alias("n")), "district_id", 1998)


@query("dq_weighted_audit", "SELECT district_id, abs(sped_teachers + gened_teachers - CAST(staff AS BIGINT)) * 100 <= 5 * staff AS ok FROM lastsped p JOIN facts f USING (district_id, year)")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")])
    x = p.join(facts(t).select("district_id", "year", "staff"), ["district_id", "year"])
    return x.select("district_id", (F.abs(c("sped_teachers") + c("gened_teachers") - c("staff").cast("long")) * 100 <= 5 * c("staff")).alias("ok"))


# ---- flagship
@query("lct_all", "SELECT district_id, state, scope, minutes, minutes_source, staff, pupils, lct, notes FROM lctsped")
def _(t):
    return lct_rows(t, True).select("district_id", "state", "scope", "minutes", "minutes_source", "staff", "pupils", "lct", "notes")


@query("lct_sped", "SELECT district_id, scope, lct, notes FROM lctsped WHERE scope IN ('core_sped', 'teachers_gened', 'instructional_sped')")
def _(t):
    return lct_rows(t, True).where(c("scope").isin(*A.SPED)).select("district_id", "scope", "lct", "notes")


@query("lct_gened_ca", "SELECT district_id, k12 - coalesce(self_contained, 0) AS pupils FROM lctbase")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).where("confidence <> 'low'").select("district_id", "self_contained")
    l = latest_per_key(levels(t), ["district_id"], [F.desc("year")]).where("k12 > 0").select("district_id", "k12")  # noqa: E741
    d = l.join(districts(t).where("not shared_service").select("district_id"), "district_id").join(p, "district_id", "left")
    return d.select("district_id", (c("k12") - F.coalesce("self_contained", F.lit(0))).alias("pupils"))


@query("lct_modes", """
    SELECT e.district_id, e.year, e.total, 'target_year' AS mode FROM enrollment e JOIN districts d ON d.district_id = e.district_id AND NOT d.shared_service WHERE e.year = 1998
    UNION ALL SELECT n.district_id, n.year, n.total, 'blended' FROM newest n JOIN districts d ON d.district_id = n.district_id AND NOT d.shared_service""")
def _(t):
    keep = districts(t).where("not shared_service").select("district_id")
    rows = lambda df, mode: df.join(keep, "district_id").select("district_id", "year", "total", F.lit(mode).alias("mode"))
    return rows(enrollment(t).where("year = 1998"), "target_year").unionByName(rows(newest(t), "blended"))


@query("lct_cols", "SELECT district_id, scope, CASE WHEN scope IN ('core_sped', 'teachers_gened', 'instructional_sped') THEN 'estimate' END AS enrollment_source FROM lctsped")
def _(t):
    return lct_rows(t, True).select("district_id", "scope", F.when(c("scope").isin(*A.SPED), "estimate").alias("enrollment_source"))
