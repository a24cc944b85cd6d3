"""Windows, sorting and tops, set operations and changes of shape."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.relational import absent, chunked, latest_per_key, pivot_sum, top_per_group, unpivot_present
from .aggregations import latest_scopes, lct_rows
from .model import CATEGORIES, GRADES, attempts, bell, counts, districts, staff
from .registry import query

c = F.col


# ---- windows
@query("win_row_number", "SELECT district_id, state, enrollment, row_number() OVER (PARTITION BY state ORDER BY enrollment DESC, district_id) AS place FROM districts WHERE district_id NOT IN (SELECT district_id FROM bell WHERE confidence = 'high')")
def _(t):
    d = absent(districts(t), bell(t).where("confidence = 'high'"), ["district_id"])
    return d.select("district_id", "state", "enrollment", F.row_number().over(Window.partitionBy("state").orderBy(F.desc("enrollment"), "district_id")).alias("place"))


def enriched(t):
    b = bell(t, 1998).select("district_id").distinct().withColumn("has", F.lit(1))
    return districts(t).join(b, "district_id", "left").withColumn("enriched", c("has").isNotNull())


_ENRICHED = "(SELECT d.*, b.district_id IS NOT NULL AS enriched FROM districts d LEFT JOIN (SELECT DISTINCT district_id FROM bell WHERE year = 1998) b ON b.district_id = d.district_id)"


@query("win_avg_part", f"SELECT district_id, round(avg(CAST(enriched AS INTEGER)) OVER (PARTITION BY state), 6) AS share FROM {_ENRICHED}")
def _(t):
    # a state's rate comes from one row a state, joined back: no state's rows are buffered in a window
    e = enriched(t)
    rate = e.groupBy("state").agg(F.round(F.avg(c("enriched").cast("int")), 6).alias("share"))
    return e.join(rate, "state").select("district_id", "share")


_PRIORITY = f"""
    SELECT district_id, state, enrollment, round(0.5 * greatest(enrollment, 0) * 10.0 / (SELECT max(enrollment) FROM districts) + 0.3 * (1 - share) * 10 + 0.2 * 5, 6) AS priority
    FROM (SELECT *, avg(CAST(enriched AS INTEGER)) OVER (PARTITION BY state) AS share FROM {_ENRICHED}) WHERE NOT enriched"""


def priorities(t):
    """Pending districts with a score from size (of the largest), the state's rate and a constant."""
    e = enriched(t)
    rate = e.groupBy("state").agg(F.avg(c("enriched").cast("int")).alias("share"))
    top = e.agg(F.max("enrollment").alias("top"))
    p = 0.5 * F.greatest("enrollment", F.lit(0)) * 10.0 / c("top") + 0.3 * (1 - c("share")) * 10 + 0.2 * 5
    return e.where("not enriched").join(rate, "state").crossJoin(F.broadcast(top)).select("district_id", "state", "enrollment", F.round(p, 6).alias("priority"))  # one row


@query("win_global_max", _PRIORITY)
def _(t):
    return priorities(t)


@query("win_topk_group", "SELECT state, district_id, enrollment FROM districts QUALIFY row_number() OVER (PARTITION BY state ORDER BY enrollment DESC, district_id) <= 3")
def _(t):
    return top_per_group(districts(t), ["state"], [F.desc("enrollment"), c("district_id")], 3).select("state", "district_id", "enrollment")


@query("win_chunk", """
    WITH x AS (SELECT district_id, segment, (row_number() OVER (PARTITION BY segment ORDER BY enrollment DESC, district_id) - 1) // 15 AS chunk FROM districts)
    SELECT district_id, segment, chunk, CAST(dense_rank() OVER (ORDER BY segment, chunk) AS BIGINT) AS batch FROM x""")
def _(t):
    x = chunked(districts(t), ["segment"], [F.desc("enrollment"), c("district_id")], 15).select("district_id", "segment", "chunk")
    # batches are numbered from the number of chunks of each group, one row a group
    sizes = x.groupBy("segment").agg((F.max("chunk") + 1).alias("n"))
    before = sizes.select("segment", (F.sum("n").over(Window.orderBy("segment")) - c("n")).alias("before"))
    return x.join(F.broadcast(before), "segment").select("district_id", "segment", "chunk", (c("before") + c("chunk") + 1).alias("batch"))


@query("win_first_level", "SELECT district_id, grade_level, arg_min(bell_id, bell_id) AS bell_id, arg_min(minutes, bell_id) AS minutes FROM bell GROUP BY 1, 2")
def _(t):
    first = F.min(F.struct("bell_id", "minutes"))
    return bell(t).groupBy("district_id", "grade_level").agg(first.alias("f")).select("district_id", "grade_level", "f.bell_id", "f.minutes")


@query("win_percentile", """
    SELECT district_id, round(percent_rank() OVER (PARTITION BY state ORDER BY lct) * 100, 4) AS percentile,
           CASE WHEN lct < 15 THEN 'Very Low' WHEN lct < 20 THEN 'Low' WHEN lct < 30 THEN 'Moderate' ELSE 'High' END AS category FROM lctrows WHERE scope = 'teachers_only'""")
def _(t):
    r = lct_rows(t).where("scope = 'teachers_only'")
    cat = F.when(c("lct") < 15, "Very Low").when(c("lct") < 20, "Low").when(c("lct") < 30, "Moderate").otherwise("High")
    return r.select("district_id", F.round(F.percent_rank().over(Window.partitionBy("state").orderBy("lct")) * 100, 4).alias("percentile"), cat.alias("category"))


# ---- sort and limit
@query("srt_state", "SELECT district_id, enrollment FROM districts WHERE state = 'NATION_3' ORDER BY enrollment DESC NULLS FIRST, district_id")
def _(t):
    return districts(t).where("state = 'NATION_3'").select("district_id", "enrollment").orderBy(F.desc_nulls_first("enrollment"), "district_id")


@query("top_n", "SELECT district_id, enrollment FROM districts WHERE enrollment IS NOT NULL ORDER BY enrollment DESC, district_id LIMIT 10")
def _(t):
    return districts(t).where("enrollment is not null").select("district_id", "enrollment").orderBy(F.desc("enrollment"), "district_id").limit(10)


@query("top_targets", "SELECT district_id, state, enrollment FROM districts WHERE enrollment BETWEEN 1000 AND 8000 AND district_id NOT IN (SELECT district_id FROM bell WHERE year = 1998) ORDER BY enrollment DESC, district_id LIMIT 25")
def _(t):
    d = absent(districts(t).where("enrollment between 1000 and 8000"), bell(t, 1998), ["district_id"])
    return d.select("district_id", "state", "enrollment").orderBy(F.desc("enrollment"), "district_id").limit(25)


@query("top_next", f"SELECT district_id, enrollment FROM {_ENRICHED} WHERE NOT enriched AND state = 'NATION_5' ORDER BY enrollment DESC, district_id LIMIT 10")
def _(t):
    return enriched(t).where("not enriched and state = 'NATION_5'").select("district_id", "enrollment").orderBy(F.desc("enrollment"), "district_id").limit(10)


@query("top_cand", f"SELECT * FROM ({_PRIORITY}) ORDER BY priority DESC, district_id LIMIT 20")
def _(t):
    return priorities(t).orderBy(F.desc("priority"), "district_id").limit(20)


_URLS = "CASE WHEN contains(lower(url), 'bell') THEN 0.5 ELSE 0 END + CASE WHEN contains(lower(url), 'about') THEN 0.25 ELSE 0 END + CASE WHEN contains(lower(url), 'news') THEN -0.25 ELSE 0 END"


@query("top_urls", f"SELECT page_id, url, CAST({_URLS} AS DOUBLE) AS score FROM pages ORDER BY score DESC, page_id LIMIT 10")
def _(t):
    u = F.lower("url")
    score = sum((F.when(u.contains(w), v).otherwise(0.0) for w, v in (("bell", 0.5), ("about", 0.25), ("news", -0.25))), F.lit(0.0))
    return t.pages.select("page_id", "url", score.alias("score")).orderBy(F.desc("score"), "page_id").limit(10)


@query("top_extremes", """
    (SELECT 'highest' AS kind, district_id, lct FROM lctrows WHERE scope = 'teachers_core' ORDER BY lct DESC, district_id LIMIT 5) UNION ALL (SELECT 'lowest' AS kind, district_id, lct FROM lctrows WHERE scope = 'teachers_core' ORDER BY lct, district_id LIMIT 5)""")
def _(t):
    r = lct_rows(t).where("scope = 'teachers_core'").select("district_id", "lct")
    top = r.orderBy(F.desc("lct"), "district_id").limit(5).select(F.lit("highest").alias("kind"), "*")
    return top.unionByName(r.orderBy("lct", "district_id").limit(5).select(F.lit("lowest").alias("kind"), "*"))


@query("srt_custom", "SELECT state, count(*) AS n, coalesce(list_position(['NATION_7', 'NATION_2', 'NATION_9'], state), 999) AS place FROM districts GROUP BY 1 ORDER BY place, state")
def _(t):
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ("NATION_7", "NATION_2", "NATION_9"))), c("state")), F.lit(0)), F.lit(999))
    return districts(t).groupBy("state").agg(F.count("*").alias("n")).withColumn("place", place).orderBy("place", "state")


@query("srt_multi", "SELECT k % 5 + 1 AS tier, status, district_id, attempt_id FROM attempts WHERE NOT skip ORDER BY tier, status, district_id, timing DESC, attempt_id")
def _(t):
    a = attempts(t).where("not skip").withColumn("tier", c("k") % 5 + 1)
    return a.orderBy("tier", "status", "district_id", F.desc("timing"), "attempt_id").select("tier", "status", "district_id", "attempt_id")


@query("first_one", "SELECT district_id, bell_id FROM bell WHERE grade_level = 'high' ORDER BY bell_id LIMIT 1")
def _(t):
    return bell(t).where("grade_level = 'high'").select("district_id", "bell_id").orderBy("bell_id").limit(1)


_OUT = "SELECT scope, district_id, lct, CASE WHEN lct > 200 THEN 'info' ELSE 'warn' END AS severity, coalesce(list_position(['teachers_only', 'teachers_core', 'instructional'], scope), 9) AS so FROM lctrows WHERE (lct < 5 OR lct > 200) AND scope IN ('teachers_only', 'teachers_core', 'instructional')"


def outliers(rows, per_scope=5, most=20):
    """Values under 5 and over 200, at most `per_scope` of a scope and severity and `most` in all, in the order of scopes."""
    place = F.array_position(F.array(*map(F.lit, ("teachers_only", "teachers_core", "instructional"))), c("scope"))
    o = rows.where("(lct < 5 or lct > 200) and scope in ('teachers_only', 'teachers_core', 'instructional')").select("scope", "district_id", "lct", F.when(c("lct") > 200, "info").otherwise("warn").alias("severity"), place.alias("so"))
    o = top_per_group(o, ["scope", "severity"], [c("lct"), c("district_id")], per_scope)
    return o.orderBy("so", F.desc("severity"), "lct", "district_id").limit(most).select("scope", "severity", "district_id", "lct")


OUTLIERS_SQL = f"SELECT scope, severity, district_id, lct FROM (SELECT * FROM ({_OUT}) QUALIFY row_number() OVER (PARTITION BY scope, severity ORDER BY lct, district_id) <= 5) ORDER BY so, severity DESC, lct, district_id LIMIT 20"


@query("lim_outliers", OUTLIERS_SQL)
def _(t):
    return outliers(lct_rows(t))


# ---- sets and shapes
@query("set_union_all", 'SELECT district_id, unnest([\'teachers_only\', \'teachers_core\', \'instructional\', \'all\']) AS scope, unnest([teachers_only, teachers_core, instructional, "all"]) AS value FROM lastscopes')
def _(t):
    return latest_scopes(t).unpivot(["district_id"], ["teachers_only", "teachers_core", "instructional", "all"], "scope", "value")


@query("set_union_metrics", "SELECT 'districts' AS metric, count(*) AS value FROM districts UNION ALL SELECT 'schedules', count(*) FROM bell UNION ALL SELECT 'attempts', count(*) FROM attempts")
def _(t):
    n = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
    return n(districts(t), "districts").unionByName(n(bell(t), "schedules")).unionByName(n(attempts(t), "attempts"))


@query("set_concat", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t):
    return t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name")).unionByName(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name")))


@query("set_diff", "SELECT district_id, array_to_string(list_sort(list_filter(['elementary', 'high', 'middle'], lambda x: NOT list_contains(found, x))), ',') AS missing FROM (SELECT district_id, list(DISTINCT grade_level) AS found FROM bell GROUP BY 1)")
def _(t):
    levels = F.array(*map(F.lit, ("elementary", "high", "middle")))
    return bell(t).groupBy("district_id").agg(F.array_join(F.array_sort(F.array_except(levels, F.collect_set("grade_level"))), ",").alias("missing"))


@query("set_dedup", "SELECT district_id, grade_level, minutes, bell_id FROM bell QUALIFY row_number() OVER (PARTITION BY district_id, grade_level ORDER BY bell_id) = 1")
def _(t):
    return latest_per_key(bell(t), ["district_id", "grade_level"], [c("bell_id")]).select("district_id", "grade_level", "minutes", "bell_id")


@query("rsh_pivot_sum", "SELECT district_id, year, " + ", ".join(f"CAST(sum(n) FILTER (category = '{k}') AS BIGINT) AS \"{k}\"" for k in CATEGORIES) + " FROM counts GROUP BY 1, 2")
def _(t):
    return pivot_sum(counts(t), ["district_id", "year"], "category", "n", list(CATEGORIES))


@query("rsh_pivot_fill", "SELECT district_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (category = '{k}'), 0) AS BIGINT) AS \"{k}\"" for k in (*CATEGORIES, "XX")) + " FROM counts GROUP BY 1")
def _(t):
    return pivot_sum(counts(t), ["district_id"], "category", "n", [*CATEGORIES, "XX"], 0)


@query("rsh_pivot_first", "SELECT district_id, " + ", ".join(f"min(minutes) FILTER (grade_level = '{k}') AS {k}" for k in ("high", "middle", "elementary")) + " FROM bell GROUP BY 1")
def _(t):
    return bell(t).groupBy("district_id").pivot("grade_level", ["high", "middle", "elementary"]).agg(F.min("minutes"))


_G = list(GRADES.values())


@query("rsh_pivot_grade", "SELECT district_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (grade = '{g}'), 0) AS BIGINT) AS \"g{g}\"" for g in _G) + ", CAST(coalesce(sum(n) FILTER (grade IN ('KG', '01', '05')), 0) AS BIGINT) AS elementary FROM counts GROUP BY 1")
def _(t):
    wide = pivot_sum(counts(t), ["district_id"], "grade", "n", _G, 0)
    return wide.select("district_id", *[c(g).alias(f"g{g}") for g in _G], (c("KG") + c("01") + c("05")).alias("elementary"))


@query("rsh_unpivot_scope", "SELECT district_id, scope, value FROM (SELECT district_id, unnest(['teachers_only', 'teachers_k5', 'teachers_612']) AS scope, unnest([teachers_only, teachers_k5, teachers_612]) AS value FROM lastscopes) WHERE value IS NOT NULL")
def _(t):
    return unpivot_present(latest_scopes(t), ["district_id"], ["teachers_only", "teachers_k5", "teachers_612"], "scope", "value")


@query("rsh_nest_json", """
    SELECT district_id, year, '{' || coalesce(string_agg('"' || cat || '":' || v, ',' ORDER BY cat) FILTER (v > 0), '') || '}' AS body
    FROM (SELECT district_id, year, unnest(['elementary', 'paras', 'secondary']) AS cat, unnest([elementary, paras, secondary]) AS v FROM staff) GROUP BY 1, 2""")
def _(t):
    m = F.create_map(*[x for k in ("elementary", "paras", "secondary") for x in (F.lit(k), c(k))])
    return staff(t).select("district_id", "year", F.to_json(F.map_filter(m, lambda k, v: v > 0)).alias("body"))


@query("rsh_nest_group", "SELECT district_id, string_agg(grade_level || '=' || n, ';' ORDER BY grade_level) AS body FROM (SELECT district_id, grade_level, count(*) AS n FROM bell GROUP BY 1, 2) GROUP BY 1")
def _(t):
    n = bell(t).groupBy("district_id", "grade_level").agg(F.count("*").alias("n"))
    return n.groupBy("district_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("grade_level", "n"))), lambda x: F.concat(x["grade_level"], F.lit("="), x["n"].cast("string"))), ";").alias("body"))
