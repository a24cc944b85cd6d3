"""Projections and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..operators import attention as A
from .model import bell, counts, districts, enrollment, lea_ratios, requirements, staff, state_ratios
from .registry import query, share

share("facts", """
    SELECT s.district_id, s.year, CAST(coalesce(elementary, 0) + coalesce(secondary, 0) + coalesce(kindergarten, 0) AS DOUBLE) AS staff, total AS pupils, CAST(120 + s.year % 7 * 70 AS BIGINT) AS minutes
    FROM staff s JOIN enrollment e ON s.district_id = e.district_id AND s.year = e.year""")


def facts(t):
    s = staff(t).withColumn("staff", (F.coalesce("elementary", F.lit(0)) + F.coalesce("secondary", F.lit(0)) + F.coalesce("kindergarten", F.lit(0))).cast("double"))
    return s.join(enrollment(t), ["district_id", "year"]).select("district_id", "year", "staff", F.col("total").alias("pupils"), (120 + F.col("year") % 7 * 70).cast("long").alias("minutes"))


LCT = "CASE WHEN staff > 0 AND pupils > 0 THEN minutes * staff / pupils END"


@query("prj_lct", f"SELECT district_id, year, round({LCT}, 6) AS lct FROM facts")
def _(t):
    return facts(t).select("district_id", "year", F.round(A.attention(F.col("minutes"), F.col("staff"), F.col("pupils")), 6).alias("lct"))


_ERROR = "CASE WHEN pupils <= 0 THEN 'enrollment must be positive' WHEN staff < 0 THEN 'staff cannot be negative' WHEN minutes NOT BETWEEN 180 AND 480 THEN 'minutes out of range' END"


@query("prj_lct_strict", f"SELECT district_id, year, {_ERROR} AS error, CASE WHEN ({_ERROR}) IS NULL THEN round(minutes * staff / pupils, 4) END AS lct FROM facts")
def _(t):
    e = A.attention_error(F.col("minutes"), F.col("staff"), F.col("pupils"))
    return facts(t).select("district_id", "year", e.alias("error"), F.when(e.isNull(), F.round(F.col("minutes") * F.col("staff") / F.col("pupils"), 4)).alias("lct"))


@query("prj_lct_extra", f"SELECT district_id, year, round(({LCT}) / 60, 10) AS hours, round(({LCT}) * 180 / 60, 10) AS yearly, round(pupils / nullif(staff, 0), 10) AS ratio FROM facts")
def _(t):
    lct = A.attention(F.col("minutes"), F.col("staff"), F.col("pupils"))
    return facts(t).select("district_id", "year", F.round(lct / 60, 10).alias("hours"), F.round(lct * 180 / 60, 10).alias("yearly"), F.round(F.try_divide("pupils", "staff"), 10).alias("ratio"))


@query("prj_lct_batch", f"SELECT coalesce({_ERROR}, 'ok') AS error, count(*) AS n FROM facts GROUP BY 1")
def _(t):
    e = A.attention_error(F.col("minutes"), F.col("staff"), F.col("pupils"))
    return facts(t).groupBy(F.coalesce(e, F.lit("ok")).alias("error")).agg(F.count("*").alias("n"))


@query("prj_lct_inverse", f"SELECT district_id, year, round(360 / nullif({LCT}, 0), 10) AS ratio FROM facts")
def _(t):
    return facts(t).select("district_id", "year", F.round(F.try_divide(F.lit(360), A.attention(F.col("minutes"), F.col("staff"), F.col("pupils"))), 10).alias("ratio"))


@query("prj_lct_text", f"SELECT district_id, year, 'Each pupil could have ' || CAST(CAST(floor({LCT}) AS BIGINT) AS VARCHAR) || ' minutes a day' AS text FROM facts WHERE ({LCT}) IS NOT NULL")
def _(t):
    lct = A.attention(F.col("minutes"), F.col("staff"), F.col("pupils"))
    return facts(t).where(lct.isNotNull()).select("district_id", "year", F.format_string("Each pupil could have %d minutes a day", F.floor(lct)).alias("text"))


@query("prj_weighted_minutes", """
    SELECT district_id, round(sum(n * coalesce(m, 0)) / nullif(sum(n), 0), 4) AS minutes
    FROM (SELECT district_id, n, CASE grade WHEN 'KG' THEN 300 WHEN '01' THEN 330 WHEN '05' THEN 345 WHEN '09' THEN 380 END AS m FROM counts) GROUP BY 1""")
def _(t):
    m = F.when(F.col("grade") == "KG", 300).when(F.col("grade") == "01", 330).when(F.col("grade") == "05", 345).when(F.col("grade") == "09", 380)
    c = counts(t).select("district_id", "n", F.coalesce(m, F.lit(0)).alias("m"))
    return c.groupBy("district_id").agg(F.round(F.try_divide(F.sum(F.col("n") * F.col("m")).cast("double"), F.sum("n").cast("double")), 4).alias("minutes"))


@query("prj_state_minutes", "SELECT district_id, coalesce(nullif(high, 0), nullif(middle, 0), 300) AS minutes FROM districts d LEFT JOIN requirements r ON d.state = r.state AND high < 400")
def _(t):
    r = requirements(t).where("high < 400")
    return districts(t).join(F.broadcast(r), "state", "left").select("district_id", F.coalesce(F.nullif("high", F.lit(0)), F.nullif("middle", F.lit(0)), F.lit(300)).alias("minutes"))  # one row a state


@query("prj_minutes_case", "SELECT state, coalesce(nullif(high, 0), fallback) AS high, coalesce(nullif(middle, 0), fallback) AS middle, coalesce(nullif(elementary, 0), fallback) AS elementary FROM requirements")
def _(t):
    return requirements(t).select("state", *[F.coalesce(F.nullif(c, F.lit(0)), "fallback").alias(c) for c in ("high", "middle", "elementary")])


_E, _S, _K, _U, _P, _C = (f"coalesce({x}, 0)" for x in ("elementary", "secondary", "kindergarten", "ungraded", "paras", "coordinators"))
SCOPES_SQL = f"""
    SELECT district_id, year, CAST(nullif({_E} + {_S} + {_K}, 0) AS DOUBLE) AS teachers_only, CAST(nullif({_E} + {_K}, 0) AS DOUBLE) AS teachers_k5, CAST(nullif({_S}, 0) AS DOUBLE) AS teachers_612,
           CAST(nullif({_E} + {_S} + {_K} + {_U}, 0) AS DOUBLE) AS teachers_core, CAST(nullif({_E} + {_S} + {_K} + {_U} + {_C} + {_P}, 0) AS DOUBLE) AS instructional,
           CAST(nullif({_E} + {_S} + {_K} + {_U} + {_C} + {_P} + {_P} // 2, 0) AS DOUBLE) AS instructional_plus_support, CAST(nullif({_E} + {_S} + {_K} + {_U} + {_C} + {_P} + {_P} // 2 + {_C} // 3, 0) AS DOUBLE) AS "all"
    FROM staff"""
share("scopes", SCOPES_SQL)


@query("prj_scopes", "SELECT * FROM scopes")
def _(t):
    return A.with_scopes(staff(t)).drop("elementary", "secondary", "kindergarten", "ungraded", "paras", "coordinators")


@query("prj_k12", "SELECT district_id, year, total - coalesce(prek, 0) AS k12 FROM enrollment")
def _(t):
    return enrollment(t).select("district_id", "year", (F.col("total") - F.coalesce("prek", F.lit(0))).alias("k12"))


share("levels", """
    SELECT district_id, year, CAST(coalesce(sum(n) FILTER (grade IN ('KG', '01', '05')), 0) * 10 AS BIGINT) AS k5, CAST(coalesce(sum(n) FILTER (grade IN ('06', '08', '09')), 0) * 10 AS BIGINT) AS g612,
           CAST(sum(n) * 10 - coalesce(sum(n) FILTER (grade = 'PK'), 0) * 10 AS BIGINT) AS k12
    FROM counts GROUP BY 1, 2""")


def levels(t):
    some = lambda *g: F.coalesce(F.sum(F.when(F.col("grade").isin(*g), F.col("n"))), F.lit(0)) * 10
    return counts(t).groupBy("district_id", "year").agg(some("KG", "01", "05").alias("k5"), some("06", "08", "09").alias("g612"), (F.sum("n") * 10 - some("PK")).alias("k12"))


@query("prj_level_enroll", "SELECT * FROM levels")
def _(t):
    return levels(t)


_RATIO = "CAST(nullif({0}, 0) AS DOUBLE) / nullif({1}, 0)"


@query("prj_sped_ratios", f"SELECT district_id, year, round({_RATIO.format('paras', 'elementary')}, 6) AS paras_ratio, round({_RATIO.format('coordinators', 'paras')}, 6) AS coordinator_ratio, round({_RATIO.format('ungraded + paras', 'elementary')}, 6) AS instructional_ratio FROM staff")
def _(t):
    r = lambda a, b: F.round(F.try_divide(N.truthy(a), N.truthy(b)), 6)
    c = F.col
    return staff(t).select("district_id", "year", r(c("paras"), c("elementary")).alias("paras_ratio"), r(c("coordinators"), c("paras")).alias("coordinator_ratio"), r(c("ungraded") + c("paras"), c("elementary")).alias("instructional_ratio"))


@query("prj_lea_ratio", f"SELECT district_id, year, round({_RATIO.format('paras', 'coalesce(nullif(elementary, 0), secondary)')}, 6) AS ratio FROM staff")
def _(t):
    return staff(t).select("district_id", "year", F.round(F.try_divide(N.truthy(F.col("paras")), N.truthy(F.coalesce(F.nullif("elementary", F.lit(0)), "secondary"))), 6).alias("ratio"))


@query("prj_ca_prop", f"SELECT district_id, year, round({_RATIO.format('prek', 'total')}, 6) AS share FROM enrollment")
def _(t):
    return enrollment(t).select("district_id", "year", F.round(F.try_divide(N.truthy(F.col("prek")), N.truthy(F.col("total"))), 6).alias("share"))


@query("prj_ca_env", "SELECT district_id, year, nullif(elementary, 0) + nullif(secondary, 0) AS mainstreamed, nullif(paras, 0) + nullif(coordinators, 0) AS self_contained FROM staff")
def _(t):
    z = lambda c: F.nullif(c, F.lit(0))
    return staff(t).select("district_id", "year", (z("elementary") + z("secondary")).alias("mainstreamed"), (z("paras") + z("coordinators")).alias("self_contained"))


@query("prj_lcff", "SELECT district_id, year, CASE WHEN coalesce(nullif(paras, 0), nullif(coordinators, 0)) IS NOT NULL THEN coalesce(paras, 0) + coalesce(coordinators, 0) END AS equity FROM staff WHERE coalesce(elementary, 0) <> 0")
def _(t):
    some = F.coalesce(F.nullif("paras", F.lit(0)), F.nullif("coordinators", F.lit(0)))
    return staff(t).where("coalesce(elementary, 0) <> 0").select("district_id", "year", F.when(some.isNotNull(), F.coalesce("paras", F.lit(0)) + F.coalesce("coordinators", F.lit(0))).alias("equity"))


share("ratiomeans", "SELECT avg(self_contained) AS sc, avg(teacher_ratio) AS tr, avg(instructional_ratio) AS ir FROM stateratios WHERE teacher_ratio IS NOT NULL")
SPED_SQL = """
    SELECT district_id, year, sped, self_contained, pupils - self_contained AS gened, sped_teachers, sped_instructional, gened_teachers, method, CASE WHEN gened_teachers < 0 THEN 'low' ELSE 'medium' END AS confidence, pupils
    FROM (SELECT *, round_even(staff - sped_teachers, 2) AS gened_teachers
    FROM (SELECT *, round_even(self_contained * tr, 2) AS sped_teachers, round_even(self_contained * ir, 2) AS sped_instructional
    FROM (SELECT *, CAST(round_even(sped * sc, 0) AS BIGINT) AS self_contained
    FROM (SELECT f.district_id, f.year, f.pupils, f.staff, CAST(round_even(f.pupils * coalesce(l.proportion, s.proportion), 0) AS BIGINT) AS sped,
                 CASE WHEN s.teacher_ratio IS NULL OR s.self_contained IS NULL THEN m.sc ELSE s.self_contained END AS sc, CASE WHEN s.teacher_ratio IS NULL OR s.self_contained IS NULL THEN m.tr ELSE s.teacher_ratio END AS tr,
                 CASE WHEN s.teacher_ratio IS NULL OR s.self_contained IS NULL THEN m.ir ELSE s.instructional_ratio END AS ir,
                 CASE WHEN s.teacher_ratio IS NULL OR s.self_contained IS NULL THEN 'national_average_fallback' WHEN l.proportion IS NOT NULL THEN 'lea_ratio' ELSE 'state_ratio' END AS method
          FROM facts f JOIN districts d ON d.district_id = f.district_id LEFT JOIN learatios l ON l.district_id = f.district_id JOIN stateratios s ON s.state = d.state CROSS JOIN ratiomeans m
          WHERE coalesce(l.proportion, s.proportion) IS NOT NULL AND f.pupils > 0))))"""
share("sped", SPED_SQL)


def sped(t):
    """The special-education estimates of each district and year."""
    rows = facts(t).withColumnRenamed("staff", "teachers").join(districts(t).select("district_id", "state"), "district_id")
    return A.special_education(rows, lea_ratios(t), state_ratios(t), "year", "pupils")


@query("prj_sped_est", "SELECT * FROM sped")
def _(t):
    return sped(t)


@query("prj_rename_map", "SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS district_id, c_name AS name, c_mktsegment AS segment FROM customer")
def _(t):
    mapping = {"c_custkey": "district_id", "c_name": "name", "c_mktsegment": "segment", "absent": "x"}
    c = t.customer
    renamed = c.withColumnsRenamed({k: v for k, v in mapping.items() if k in c.columns})
    return renamed.select([v for v in mapping.values() if v in renamed.columns]).withColumn("district_id", F.lpad(F.col("district_id").cast("string"), 7, "0"))


def infer_names(columns: list[str]) -> dict[str, str]:
    """Standard names for columns by the keywords in theirs; each standard name goes to the first that has one of its keywords."""
    rules = (("district_id", ("id", "code", "key")), ("name", ("name", "district")), ("enrollment", ("enroll", "student", "bal")), ("staff", ("teacher", "staff")))
    out: dict[str, str] = {}
    for standard, words in rules:
        for c in columns:
            if c not in out and any(w in c.lower() for w in words):
                out[c] = standard
                break
    return out


@query("prj_rename_infer", "SELECT c_custkey AS district_id, c_name AS name, c_acctbal AS enrollment, c_nationkey, c_mktsegment FROM customer")
def _(t):
    return t.customer.withColumnsRenamed(infer_names(t.customer.columns))


@query("prj_map_infer", "SELECT * FROM (VALUES ('c_custkey', 'district_id'), ('c_name', 'name'), ('c_acctbal', 'enrollment')) v(found, standard)")
def _(t):
    return t.values("found string, standard string", *infer_names(t.customer.columns).items())


@query("prj_fill_totals", "SELECT district_id, year, coalesce(CAST(NULL AS BIGINT), coalesce(elementary, 0) + coalesce(secondary, 0)) AS staff_total FROM staff")
def _(t):
    s = staff(t).withColumn("staff_total", F.lit(None).cast("long"))
    return s.select("district_id", "year", F.coalesce("staff_total", F.coalesce("elementary", F.lit(0)) + F.coalesce("secondary", F.lit(0))).alias("staff_total"))


@query("prj_alloc_staff", """
    SELECT district_id, year, round(CASE WHEN m + h > 0 THEN secondary * m / (m + h) ELSE 0 END, 4) AS middle, round(CASE WHEN m + h > 0 THEN secondary * h / (m + h) ELSE 0 END, 4) AS high
    FROM (SELECT district_id, year, CAST(coalesce(sum(n) FILTER (grade IN ('06', '08')), 0) AS DOUBLE) AS m, CAST(coalesce(sum(n) FILTER (grade = '09'), 0) AS DOUBLE) AS h FROM counts GROUP BY 1, 2) JOIN staff USING (district_id, year)""")
def _(t):
    some = lambda *g: F.coalesce(F.sum(F.when(F.col("grade").isin(*g), F.col("n"))), F.lit(0)).cast("double")
    mh = counts(t).groupBy("district_id", "year").agg(some("06", "08").alias("m"), some("09").alias("h"))
    part = lambda c: F.round(F.when(F.col("m") + F.col("h") > 0, F.col("secondary") * F.col(c) / (F.col("m") + F.col("h"))).otherwise(0), 4)
    return mh.join(staff(t), ["district_id", "year"]).select("district_id", "year", part("m").alias("middle"), part("h").alias("high"))


@query("prj_data_tier", "SELECT district_id, CASE WHEN minutes_source = 'bell_schedule' THEN 1 WHEN minutes_source LIKE 'bell_schedule%' THEN 2 ELSE 3 END AS tier FROM minuteschain")
def _(t):
    return A.minutes_chain(bell(t), requirements(t), districts(t)).select("district_id", A.data_tier(F.col("minutes_source")).alias("tier"))


SIZE = "CASE WHEN enrollment > 8000 THEN 'Large' WHEN enrollment >= 1000 THEN 'Medium' ELSE 'Small' END"


def size_class(c, large=8000, medium=1000):
    return F.when(c > large, "Large").when(c >= medium, "Medium").otherwise("Small")


@query("prj_size_case", f"SELECT district_id, {SIZE} AS size FROM districts")
def _(t):
    return districts(t).select("district_id", size_class(F.col("enrollment")).alias("size"))


@query("prj_status_case", "SELECT district_id, CASE WHEN count(*) >= 12 THEN 'complete' WHEN count(*) FILTER (confidence = 'high') > 0 THEN 'in_progress' ELSE 'not_started' END AS status FROM bell GROUP BY 1")
def _(t):
    return bell(t).groupBy("district_id").agg(F.when(F.count("*") >= 12, "complete").when(F.count_if(F.col("confidence") == "high") > 0, "in_progress").otherwise("not_started").alias("status"))


@query("prj_temporal_case", "SELECT district_id, CASE WHEN max(year) - min(year) = 0 THEN 'SAME_YEAR' WHEN max(year) - min(year) <= 3 THEN 'VALID_BLEND' ELSE 'SPAN_EXCEEDED' END AS class FROM bell GROUP BY 1")
def _(t):
    return bell(t).groupBy("district_id").agg(D.temporal_class(F.max("year") - F.min("year")).alias("class"))


@query("prj_conf_case", "SELECT event_id, CASE WHEN value / 100 >= 0.8 THEN 'high' WHEN value / 100 >= 0.5 THEN 'medium' ELSE 'low' END AS confidence FROM events")
def _(t):
    v = F.col("value") / 100
    return t.events.select("event_id", F.when(v >= 0.8, "high").when(v >= 0.5, "medium").otherwise("low").alias("confidence"))


@query("prj_sched_level", "SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%large%' THEN 'high' WHEN lower(p_name) LIKE '%blue%' THEN 'middle' WHEN lower(p_name) LIKE '%small%' THEN 'elementary' ELSE 'high' END AS level FROM part")
def _(t):
    n = F.lower("p_name")
    return t.part.select("p_partkey", F.when(n.rlike("large"), "high").when(n.rlike("blue"), "middle").when(n.rlike("small"), "elementary").otherwise("high").alias("level"))


@query("prj_todict", "SELECT district_id, '{\"name\":\"' || name || '\",\"state\":\"' || state || '\",\"enrollment\":' || enrollment || '}' AS body FROM districts")
def _(t):
    return districts(t).select("district_id", F.to_json(F.struct("name", "state", "enrollment")).alias("body"))


