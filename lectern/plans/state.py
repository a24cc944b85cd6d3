"""Upserts and run state as post-image DataFrames, and the enrichment queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import attention as A
from ..operators import queue as Q
from ..operators.relational import absent, chunked, insert_absent, latest_per_key, replace_where, upsert
from .joins import newest
from .model import attempts, bell, counts, districts, requirements, staff
from .projections import facts, sped
from .registry import query, share

c = F.col
KEY = ["district_id", "year", "grade_level"]
share("bellold", "SELECT district_id, year, grade_level, minutes, bell_id FROM bell WHERE year <= 1998 QUALIFY row_number() OVER (PARTITION BY district_id, year, grade_level ORDER BY bell_id) = 1")
share("bellnew", "SELECT district_id, year, grade_level, minutes, bell_id FROM bell WHERE year >= 1998 AND minutes BETWEEN 100 AND 450 QUALIFY row_number() OVER (PARTITION BY district_id, year, grade_level ORDER BY bell_id DESC) = 1")


def bell_old(t):
    return latest_per_key(bell(t).where("year <= 1998").select(*KEY, "minutes", "bell_id"), KEY, [c("bell_id")])


def bell_new(t):
    return latest_per_key(bell(t).where("year >= 1998 and minutes between 100 and 450").select(*KEY, "minutes", "bell_id"), KEY, [F.desc("bell_id")])


_UPSERT = "SELECT * FROM bellnew UNION ALL SELECT o.* FROM bellold o WHERE NOT EXISTS (SELECT 1 FROM bellnew n WHERE n.district_id = o.district_id AND n.year = o.year AND n.grade_level = o.grade_level)"
_IGNORE = "SELECT * FROM bellold UNION ALL SELECT n.* FROM bellnew n WHERE NOT EXISTS (SELECT 1 FROM bellold o WHERE n.district_id = o.district_id AND n.year = o.year AND n.grade_level = o.grade_level)"


@query("dml_upsert_bell", _UPSERT)
def _(t):
    return upsert(bell_old(t), bell_new(t), KEY)


@query("dml_on_conflict", _UPSERT)
def _(t):
    return upsert(bell_old(t), bell_new(t), KEY)


@query("dml_conflict_nothing", _IGNORE)
def _(t):
    return insert_absent(bell_old(t), bell_new(t), KEY)


_MULTI = "SELECT state, unnest(['high', 'middle', 'elementary']) AS grade_level, unnest([high, middle, elementary]) AS minutes FROM requirements"


@query("dml_multi_grade", f"SELECT * FROM ({_MULTI}) WHERE coalesce(minutes, 0) <> 0")
def _(t):
    return requirements(t).unpivot(["state"], ["high", "middle", "elementary"], "grade_level", "minutes").where("coalesce(minutes, 0) <> 0")


@query("dml_calc_store", """
    SELECT d.district_id, g.grade_level, coalesce(b.minutes, r.high, 360) AS minutes, CASE WHEN b.method = 'human_provided' THEN 1 WHEN b.method IS NOT NULL THEN 2 ELSE 3 END AS tier
    FROM districts d CROSS JOIN (VALUES ('high'), ('middle'), ('elementary')) g(grade_level)
    LEFT JOIN (SELECT district_id, grade_level, minutes, method FROM bell WHERE minutes > 0 QUALIFY row_number() OVER (PARTITION BY district_id, grade_level ORDER BY year DESC, bell_id) = 1) b ON b.district_id = d.district_id AND b.grade_level = g.grade_level
    LEFT JOIN requirements r ON r.state = d.state""")
def _(t):
    b = latest_per_key(bell(t).where("minutes > 0").select("district_id", "grade_level", "minutes", "method", "year", "bell_id"), ["district_id", "grade_level"], [F.desc("year"), c("bell_id")])
    d = districts(t).select("district_id", "state", F.explode(F.array(*map(F.lit, ("high", "middle", "elementary")))).alias("grade_level"))
    d = d.join(b.select("district_id", "grade_level", "minutes", "method"), ["district_id", "grade_level"], "left").join(F.broadcast(requirements(t).select("state", "high")), "state", "left")  # one row a state
    return d.select("district_id", "grade_level", F.coalesce("minutes", "high", F.lit(360)).alias("minutes"), F.when(c("method") == "human_provided", 1).when(c("method").isNotNull(), 2).otherwise(3).alias("tier"))


@query("dml_merge_pk", """
    SELECT coalesce(n.district_id, o.district_id) AS district_id, coalesce(n.name, o.name) AS name, coalesce(n.url, o.url) AS url
    FROM (SELECT district_id, name, NULL AS url FROM districts WHERE enrollment > 2000) n FULL JOIN (SELECT district_id, 'old ' || name AS name, 'https://' || district_id AS url FROM districts WHERE enrollment < 6000) o ON n.district_id = o.district_id""")
def _(t):
    new = districts(t).where("enrollment > 2000").select("district_id", "name", F.lit(None).cast("string").alias("url"))
    old = districts(t).where("enrollment < 6000").select("district_id", F.concat(F.lit("old "), "name").alias("o_name"), F.concat(F.lit("https://"), "district_id").alias("o_url"))
    return new.join(old, "district_id", "full").select("district_id", F.coalesce("name", "o_name").alias("name"), F.coalesce("url", "o_url").alias("url"))


@query("dml_merge_noop", "SELECT count(*) AS rows, count(*) - count(DISTINCT (district_id, year, grade_level)) AS duplicates FROM (SELECT * FROM bellold UNION ALL SELECT * FROM bellnew)")
def _(t):
    keys = bell_old(t).unionByName(bell_new(t)).groupBy(*KEY).agg(F.count("*").alias("n"))
    return keys.agg(F.sum("n").alias("rows"), (F.sum("n") - F.count("*")).alias("duplicates"))


@query("dml_delete_year", "SELECT * FROM bellold WHERE year IS DISTINCT FROM 1998 UNION ALL SELECT * FROM bellnew WHERE year = 1998")
def _(t):
    return replace_where(bell_old(t), bell_new(t).where("year = 1998"), "year", 1998)


@query("dml_effective", 'SELECT s.district_id, s.elementary, c.teachers_only, c."all" FROM staff s JOIN scopes c ON s.district_id = c.district_id AND s.year = c.year WHERE s.year = 1997')
def _(t):
    return A.with_scopes(staff(t).where("year = 1997")).select("district_id", "elementary", "teachers_only", "all")


share("statestaff", "SELECT district_id, year, CAST(sum(n) AS BIGINT) AS teachers FROM counts WHERE source = 'state' AND category IN ('AF', 'AO') GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year DESC) = 1")


@query("dml_sea_merge", """
    SELECT s.district_id, CASE WHEN abs(x.year - 1998) <= 3 THEN x.teachers ELSE s.elementary END AS teachers_total, CASE WHEN abs(x.year - 1998) <= 3 THEN 'state' ELSE 'federal' END AS source,
           nullif(coalesce(s.elementary, 0) + coalesce(s.secondary, 0) + coalesce(s.kindergarten, 0), 0) AS teachers_k12
    FROM staff s LEFT JOIN statestaff x ON x.district_id = s.district_id WHERE s.year = 1998""")
def _(t):
    x = counts(t).where("source = 'state' and category in ('AF', 'AO')").groupBy("district_id", "year").agg(F.sum("n").alias("teachers"))
    x = latest_per_key(x, ["district_id"], [F.desc("year")]).select("district_id", c("year").alias("x_year"), "teachers")
    ok = F.coalesce(F.abs(c("x_year") - 1998) <= 3, F.lit(False))
    s = staff(t).where("year = 1998").join(x, "district_id", "left")
    z = lambda n: F.coalesce(n, F.lit(0))
    # teachers_k12 is computed again from its parts, so what the state says stays in teachers_total alone
    return s.select("district_id", F.when(ok, c("teachers")).otherwise(c("elementary")).alias("teachers_total"), F.when(ok, "state").otherwise("federal").alias("source"), F.nullif(z("elementary") + z("secondary") + z("kindergarten"), F.lit(0)).alias("teachers_k12"))


@query("dml_fl_actual", """
    SELECT district_id, CASE WHEN differs THEN actual ELSE sped END AS sped, CASE WHEN differs THEN 'actual' ELSE 'estimate' END AS method, CASE WHEN differs THEN coalesce(NULL, '') || 'replaced' ELSE '' END AS notes
    FROM (SELECT p.district_id, p.sped, e.prek AS actual, CASE WHEN coalesce(p.sped, 0) = 0 THEN true ELSE abs(e.prek - p.sped) * 100 > 5 * p.sped END AS differs FROM lastsped p JOIN newest e ON e.district_id = p.district_id WHERE e.prek IS NOT NULL)""")
def _(t):
    p = latest_per_key(sped(t), ["district_id"], [F.desc("year")]).select("district_id", "sped")
    x = p.join(newest(t).where("prek is not null").select("district_id", c("prek").alias("actual")), "district_id")
    differs = (F.coalesce("sped", F.lit(0)) == 0) | (F.abs(c("actual") - c("sped")) * 100 > 5 * c("sped"))
    return x.select("district_id", F.when(differs, c("actual")).otherwise(c("sped")).alias("sped"), F.when(differs, "actual").otherwise("estimate").alias("method"), F.when(differs, "replaced").otherwise("").alias("notes"))


@query("dml_sped_apply", """
    WITH r AS (SELECT d.state, avg(CAST(nullif(paras, 0) AS DOUBLE) / nullif(elementary, 0)) AS ratio FROM staff s JOIN districts d ON s.district_id = d.district_id GROUP BY 1 HAVING count(*) > 40), n AS (SELECT avg(ratio) AS ratio FROM r)
    SELECT f.district_id, f.year, round(coalesce(r.ratio, n.ratio), 6) AS ratio, CASE WHEN r.ratio IS NULL THEN 'national' ELSE 'state' END AS method FROM facts f JOIN districts d ON f.district_id = d.district_id LEFT JOIN r ON r.state = d.state CROSS JOIN n""")
def _(t):
    ratio = F.avg(F.try_divide(N.truthy(c("paras")), N.truthy(c("elementary"))))
    r = staff(t).join(districts(t).select("district_id", "state"), "district_id").groupBy("state").agg(ratio.alias("ratio"), F.count("*").alias("n")).where("n > 40").drop("n")
    n = r.agg(F.avg("ratio").alias("national"))
    f = facts(t).select("district_id", "year").join(districts(t).select("district_id", "state"), "district_id")
    f = f.join(F.broadcast(r), "state", "left").crossJoin(F.broadcast(n))  # one row a state; one row
    return f.select("district_id", "year", F.round(F.coalesce("ratio", "national"), 6).alias("ratio"), F.when(c("ratio").isNull(), "national").otherwise("state").alias("method"))


@query("dml_skip", "SELECT attempt_id, skip OR district_id = '0000007' AS skip, CASE WHEN district_id = '0000007' THEN 'manual' END AS reason FROM attempts")
def _(t):
    one = c("district_id") == "0000007"
    return attempts(t).select("attempt_id", (c("skip") | one).alias("skip"), F.when(one, "manual").alias("reason"))


@query("dml_pad_ids", "SELECT count(*) AS n, count(*) FILTER (length(lpad(CAST(c_custkey AS VARCHAR), 7, '0')) <> 7) AS bad FROM customer")
def _(t):
    padded = F.lpad(c("c_custkey").cast("string"), 7, "0")
    return t.customer.agg(F.count("*").alias("n"), F.count_if(F.length(padded) != 7).alias("bad"))


share("runlog", "SELECT 'run-' || user_id AS run_id, CASE event_type WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'fail' END AS event, ts AS at_time, event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n, event_type || ' ' || event_id AS message FROM events WHERE event_type IN ('view', 'purchase', 'error')")


def run_log(t):
    event = F.when(c("event_type") == "view", "start").when(c("event_type") == "purchase", "complete").otherwise("fail")
    e = t.events.where(c("event_type").isin("view", "purchase", "error"))
    return e.select(F.concat(F.lit("run-"), "user_id").alias("run_id"), event.alias("event"), c("ts").alias("at_time"), c("event_id").alias("seq"), F.get_json_object("props", "$.k").cast("long").alias("n"), F.concat_ws(" ", "event_type", "event_id").alias("message"))


@query("run_start_complete", """
    WITH s AS (SELECT run_id, max((at_time, seq)) FILTER (event = 'start') AS first FROM runlog GROUP BY 1),
    e AS (SELECT l.run_id, arg_max(event, (at_time, seq)) AS event, arg_max(n, (at_time, seq)) AS n, arg_max(message, (at_time, seq)) AS message, max((at_time, seq)) AS last
          FROM runlog l JOIN s ON l.run_id = s.run_id AND (l.at_time, l.seq) > s.first WHERE event <> 'start' GROUP BY 1)
    SELECT s.run_id, CASE WHEN e.event = 'complete' THEN 'completed' WHEN e.event = 'fail' THEN 'failed' ELSE 'running' END AS status, epoch_us(s.first[1]) AS started, epoch_us(e.last[1]) AS ended,
           CASE WHEN e.event = 'complete' THEN e.n END AS rows, CASE WHEN e.event = 'fail' THEN e.message END AS error
    FROM s LEFT JOIN e ON e.run_id = s.run_id WHERE s.first IS NOT NULL""")
def _(t):
    us = lambda n: F.unix_micros(c(n).cast("timestamp"))
    return Q.runs(run_log(t)).select("run_id", "status", us("started").alias("started"), us("ended").alias("ended"), "rows", "error")


@query("lin_log", "SELECT 'bell' AS entity_type, district_id || '/' || year || '/' || grade_level AS entity_id, 'create' AS operation, '{\"minutes\":' || minutes || '}' AS details FROM bellold")
def _(t):
    return bell_old(t).select(F.lit("bell").alias("entity_type"), F.concat_ws("/", "district_id", c("year").cast("string"), "grade_level").alias("entity_id"), F.lit("create").alias("operation"), F.to_json(F.struct("minutes")).alias("details"))


@query("dml_clear", "SELECT district_id, year FROM facts WHERE year IS DISTINCT FROM 1996")
def _(t):
    return facts(t).where(~c("year").eqNullSafe(F.lit(1996))).select("district_id", "year")


@query("dml_truncate", "SELECT * FROM bellold WHERE false")
def _(t):
    return bell_old(t).limit(0)


# ---- queue
share("queued", "SELECT district_id, max(k % 5 + 1) AS tier, CASE WHEN bool_or(status = 'success') THEN 'processing' ELSE 'pending' END AS status FROM attempts GROUP BY 1")


def queued(t):
    return attempts(t).groupBy("district_id").agg(F.max(c("k") % 5 + 1).alias("tier"), F.when(F.bool_or(c("status") == "success"), "processing").otherwise("pending").alias("status"))


@query("st_enqueue", "SELECT DISTINCT district_id, 1 AS tier, 'pending' AS status FROM districts WHERE enrollment > 5000 AND district_id NOT IN (SELECT district_id FROM queued)")
def _(t):
    return Q.enqueue(districts(t).where("enrollment > 5000"), queued(t))


@query("st_escalate", "SELECT district_id, least(tier + 1, 5) AS tier, CASE WHEN tier >= 5 THEN 'manual_review' ELSE 'pending' END AS status FROM queued")
def _(t):
    return Q.escalate(queued(t))


@query("st_block", "SELECT district_id, tier, CASE WHEN tier > 3 THEN 'manual_review' ELSE status END AS status, tier > 3 AS security_blocked FROM queued")
def _(t):
    return Q.block(queued(t), c("tier") > 3)


@query("st_complete", "SELECT district_id, tier, CASE WHEN status = 'processing' THEN 'completed' ELSE status END AS status, CASE WHEN status = 'processing' THEN true END AS success FROM queued")
def _(t):
    return Q.complete(queued(t), c("status") == "processing")


def _same(tier, status):
    return f"struct_pack(tier := CAST({tier} AS INTEGER), status := {status}, steps := CAST(s.steps + 1 AS INTEGER))"


FOLD_SQL = f"""
    WITH RECURSIVE e AS (SELECT district_id, event_type, row_number() OVER (PARTITION BY district_id ORDER BY attempted, attempt_id) AS i FROM attempts),
    f AS (SELECT DISTINCT district_id, CAST(0 AS BIGINT) AS i, struct_pack(tier := CAST(0 AS INTEGER), status := 'new', steps := CAST(0 AS INTEGER)) AS s FROM e
          UNION ALL
          SELECT f.district_id, e.i, CASE WHEN e.event_type = 'signup' THEN {_same("1", "'pending'")}
              WHEN s.status NOT IN ('new', 'pending') THEN s WHEN e.event_type = 'error' AND s.tier >= 5 THEN {_same("5", "'manual_review'")} WHEN e.event_type = 'error' THEN {_same("s.tier + 1", "'pending'")}
              WHEN e.event_type = 'view' AND s.tier >= 4 THEN {_same("s.tier", "'manual_review'")} WHEN e.event_type = 'purchase' THEN {_same("s.tier", "'completed'")} ELSE s END
          FROM f JOIN e ON e.district_id = f.district_id AND e.i = f.i + 1)
    SELECT district_id, s.tier AS tier, s.status AS status, s.steps AS steps FROM f QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY i DESC) = 1"""


@query("st_fold", FOLD_SQL)
def _(t):
    return Q.fold(attempts(t))


@query("st_attempt_log", "SELECT attempt_id, district_id, status, block_type, timing, CASE WHEN status = 'blocked' THEN 1 ELSE 0 END AS retry_count FROM attempts")
def _(t):
    return attempts(t).select("attempt_id", "district_id", "status", "block_type", "timing", F.when(c("status") == "blocked", 1).otherwise(0).alias("retry_count"))


@query("st_skip_q", "SELECT district_id, bool_or(skip) AS skip FROM attempts GROUP BY 1")
def _(t):
    return attempts(t).groupBy("district_id").agg(F.bool_or("skip").alias("skip"))


_OPEN = "(SELECT * FROM attempts WHERE district_id NOT IN (SELECT district_id FROM attempts WHERE skip))"


@query("st_autoflag", f"SELECT district_id, 'repeatedly_blocked' AS reason FROM {_OPEN} WHERE status = 'blocked' GROUP BY 1 HAVING count(*) >= 3 UNION ALL SELECT district_id, 'repeatedly_not_found' FROM {_OPEN} WHERE status = 'not_found' GROUP BY 1 HAVING count(*) >= 4")
def _(t):
    return Q.repeat_failures(attempts(t))


@query("st_history", "SELECT attempt_id, status, attempted FROM attempts WHERE district_id = '0000012' ORDER BY attempted DESC, attempt_id")
def _(t):
    return attempts(t).where("district_id = '0000012'").select("attempt_id", "status", "attempted").orderBy(F.desc("attempted"), "attempt_id")


@query("st_copy", "SELECT * FROM bellold UNION ALL SELECT n.* FROM bellnew n WHERE minutes BETWEEN 300 AND 480 AND NOT EXISTS (SELECT 1 FROM bellold o WHERE n.district_id = o.district_id AND n.year = o.year AND n.grade_level = o.grade_level)")
def _(t):
    return insert_absent(bell_old(t), bell_new(t).where("minutes between 300 and 480"), KEY)


_BUCKET = "CASE WHEN enrollment < 2000 THEN 'small' WHEN enrollment < 5000 THEN 'medium' WHEN enrollment < 8000 THEN 'large' ELSE 'very_large' END"


@query("st_batch", f"SELECT district_id, {_BUCKET} AS grp, (row_number() OVER (PARTITION BY {_BUCKET} ORDER BY enrollment DESC, district_id) - 1) // 15 AS chunk FROM districts")
def _(t):
    grp = F.when(c("enrollment") < 2000, "small").when(c("enrollment") < 5000, "medium").when(c("enrollment") < 8000, "large").otherwise("very_large")
    return chunked(districts(t).withColumn("grp", grp), ["grp"], [F.desc("enrollment"), c("district_id")], 15).select("district_id", "grp", "chunk")


@query("st_retry", "SELECT attempt_id, CASE WHEN status = 'timeout' THEN CAST(least(1000 * power(2, k % 4), 8000) AS BIGINT) END AS wait, epoch_ms(attempted) - epoch_ms(lag(attempted) OVER (PARTITION BY district_id ORDER BY attempted, attempt_id)) < 1000 AS too_soon FROM attempts")
def _(t):
    from pyspark.sql import Window

    before = F.lag("attempted").over(Window.partitionBy("district_id").orderBy("attempted", "attempt_id"))
    soon = F.unix_millis(c("attempted").cast("timestamp")) - F.unix_millis(before.cast("timestamp")) < 1000
    return attempts(t).select("attempt_id", F.when(c("status") == "timeout", N.backoff_ms(c("k") % 4 + 1)).alias("wait"), soon.alias("too_soon"))


share("patterns", """
    SELECT pattern, n, districts, rate, CASE WHEN n >= 10 AND rate < 0.2 THEN 'flagged' WHEN districts >= 3 AND rate >= 0.8 THEN 'approved' WHEN districts >= 2 THEN 'review' ELSE 'learning' END AS status
    FROM (SELECT '*p' || k || '*' AS pattern, count(*) AS n, count(DISTINCT district_id) AS districts, round(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 4) AS rate FROM attempts GROUP BY 1)""")


def patterns(t):
    return Q.pattern_status(attempts(t).select(F.format_string("*p%d*", "k").alias("pattern"), "district_id", (c("status") == "success").alias("success")))


@query("st_patterns", "SELECT * FROM patterns")
def _(t):
    return patterns(t)


@query("st_patterns_eff", "SELECT pattern FROM patterns WHERE status = 'approved' OR (districts >= 2 AND rate >= 0.5) UNION SELECT unnest(['*bell*', '*schedule*'])")
def _(t):
    base = t.values("pattern string", ("*bell*",), ("*schedule*",))
    return patterns(t).where("status = 'approved' or (districts >= 2 and rate >= 0.5)").select("pattern").unionByName(base).distinct()


@query("st_patterns_rev", "SELECT pattern, CASE status WHEN 'flagged' THEN 100 WHEN 'review' THEN 90 WHEN 'learning' THEN 80 ELSE 50 END AS priority FROM patterns ORDER BY priority DESC, pattern")
def _(t):
    p = F.when(c("status") == "flagged", 100).when(c("status") == "review", 90).when(c("status") == "learning", 80).otherwise(50)
    return patterns(t).select("pattern", p.alias("priority")).orderBy(F.desc("priority"), "pattern")


@query("st_patterns_sum", "SELECT status, count(*) AS n FROM patterns GROUP BY 1")
def _(t):
    return patterns(t).groupBy("status").agg(F.count("*").alias("n"))


@query("st_score_learn", "SELECT attempt_id, CASE WHEN k >= 80 THEN 'positive' ELSE 'negative' END AS kind FROM attempts WHERE k >= 80 OR k <= 20")
def _(t):
    return attempts(t).where("k >= 80 or k <= 20").select("attempt_id", F.when(c("k") >= 80, "positive").otherwise("negative").alias("kind"))
