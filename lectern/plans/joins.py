"""Joins."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import attention as A
from ..operators.relational import absent, coverage, latest_per_key, target_or_latest
from .model import attempts, bell, counts, districts, enrollment, requirements, staff, staff_and_enrollment
from .registry import query, share

c = F.col


@query("jn_inner_filter", "SELECT s.district_id, s.year, s.elementary FROM staff s JOIN districts d ON s.district_id = d.district_id WHERE d.segment = 'BUILDING'")
def _(t):
    return staff(t).join(districts(t).where(c("segment") == "BUILDING"), "district_id").select("district_id", "year", "elementary")


share("newest", "SELECT * FROM enrollment QUALIFY row_number() OVER (PARTITION BY district_id ORDER BY year DESC) = 1")


def newest(t):
    return latest_per_key(enrollment(t), ["district_id"], [F.desc("year")])


@query("jn_latest", "SELECT * FROM newest")
def _(t):
    return newest(t)


@query("jn_latest_sped", "SELECT district_id, year, total FROM enrollment WHERE year = 1999")
def _(t):
    return target_or_latest(enrollment(t), ["district_id"], "year", 1999, []).select("district_id", "year", "total")


@query("jn_latest_ca", "SELECT district_id, year, total FROM newest")
def _(t):
    return target_or_latest(enrollment(t), ["district_id"], "year", 2099, []).select("district_id", "year", "total")


@query("jn_dict_probe", "SELECT d.district_id, e.total, s.elementary, r.high FROM districts d JOIN newest e ON d.district_id = e.district_id AND e.total > 0 LEFT JOIN staff s ON s.district_id = d.district_id AND s.year = e.year LEFT JOIN requirements r ON r.state = d.state")
def _(t):
    d = districts(t).join(newest(t).where("total > 0"), "district_id").join(staff(t), ["district_id", "year"], "left")
    return d.join(F.broadcast(requirements(t).select("state", "high")), "state", "left").select("district_id", "total", "elementary", "high")  # one row a state


MINUTES_SQL = """
    SELECT d.district_id,
           coalesce(nullif(h.minutes, 0), nullif(m.minutes, 0), nullif(e.minutes, 0), CAST(coalesce(nullif(r.high, 0), r.fallback) AS BIGINT), 360) AS minutes,
           CASE WHEN nullif(h.minutes, 0) IS NOT NULL THEN 'bell_schedule' WHEN nullif(m.minutes, 0) IS NOT NULL THEN 'bell_schedule_middle' WHEN nullif(e.minutes, 0) IS NOT NULL THEN 'bell_schedule_elementary'
                WHEN r.state IS NOT NULL THEN 'state_requirement' ELSE 'default' END AS minutes_source,
           coalesce(CAST(CASE WHEN nullif(h.minutes, 0) IS NOT NULL THEN h.year WHEN nullif(m.minutes, 0) IS NOT NULL THEN m.year WHEN nullif(e.minutes, 0) IS NOT NULL THEN e.year END AS VARCHAR), '2023-24') AS minutes_year
    FROM districts d
    LEFT JOIN lastbell h ON h.district_id = d.district_id AND h.grade_level = 'high' LEFT JOIN lastbell m ON m.district_id = d.district_id AND m.grade_level = 'middle'
    LEFT JOIN lastbell e ON e.district_id = d.district_id AND e.grade_level = 'elementary' LEFT JOIN requirements r ON r.state = d.state"""
share("lastbell", "SELECT * FROM bell QUALIFY row_number() OVER (PARTITION BY district_id, grade_level ORDER BY year DESC, bell_id) = 1")
share("minuteschain", MINUTES_SQL)


@query("jn_fallback_chain", "SELECT * FROM minuteschain")
def _(t):
    return A.minutes_chain(bell(t), requirements(t), districts(t))


@query("jn_left_multi", "SELECT d.district_id, s.elementary, e.total, r.high FROM districts d LEFT JOIN staff s ON s.district_id = d.district_id AND s.year = 1998 LEFT JOIN enrollment e ON e.district_id = d.district_id AND e.year = 1998 LEFT JOIN requirements r ON r.state = d.state WHERE e.total > 0 AND s.elementary IS NOT NULL")
def _(t):
    s, e = staff(t).where("year = 1998").drop("year"), enrollment(t).where("year = 1998").drop("year")
    d = districts(t).join(s, "district_id", "left").join(e, "district_id", "left").join(F.broadcast(requirements(t).select("state", "high")), "state", "left")  # one row a state
    return d.where("total > 0 and elementary is not null").select("district_id", "elementary", "total", "high")


@query("jn_exists_flag", "SELECT district_id, EXISTS (SELECT 1 FROM bell b WHERE b.district_id = d.district_id AND b.year = 1997) AS has_bell FROM districts d")
def _(t):
    keys = bell(t, 1997).select("district_id").distinct().withColumn("has_bell", F.lit(True))
    return districts(t).join(keys, "district_id", "left").select("district_id", F.coalesce("has_bell", F.lit(False)).alias("has_bell"))


@query("jn_left_on_year", "SELECT d.state, count(DISTINCT d.district_id) AS districts, count(DISTINCT b.district_id) AS enriched FROM districts d LEFT JOIN bell b ON b.district_id = d.district_id AND b.year = 1996 GROUP BY 1")
def _(t):
    b = bell(t, 1996).select("district_id").distinct().withColumn("has", F.lit(1))
    return districts(t).join(b, "district_id", "left").groupBy("state").agg(F.count("district_id").alias("districts"), F.count("has").alias("enriched"))


@query("jn_anti_notin", "SELECT district_id, enrollment FROM districts WHERE enrollment >= 1000 AND district_id NOT IN (SELECT district_id FROM attempts)")
def _(t):
    return absent(districts(t).where("enrollment >= 1000"), attempts(t), ["district_id"]).select("district_id", "enrollment")


@query("jn_anti_year", "SELECT district_id FROM districts WHERE district_id NOT IN (SELECT district_id FROM bell WHERE year = 2000)")
def _(t):
    return absent(districts(t), bell(t, 2000), ["district_id"]).select("district_id")


@query("jn_anti_exists", "SELECT district_id, state, enrollment FROM districts d WHERE enrollment > 0 AND NOT EXISTS (SELECT 1 FROM bell b WHERE b.district_id = d.district_id AND b.confidence = 'high')")
def _(t):
    return absent(districts(t).where("enrollment > 0"), bell(t).where("confidence = 'high'"), ["district_id"]).select("district_id", "state", "enrollment")


@query("jn_semi_isin", "SELECT attempt_id FROM attempts WHERE district_id IN (SELECT district_id FROM districts)")
def _(t):
    return attempts(t).join(districts(t).select("district_id"), "district_id", "left_semi").select("attempt_id")


@query("jn_in_list", "SELECT district_id, name FROM districts WHERE district_id IN ('0000003', '0000009', '9999999')")
def _(t):
    return districts(t).join(t.values("district_id string", ("0000003",), ("0000009",), ("9999999",)), "district_id").select("district_id", "name")


FANOUT = "FROM districts d LEFT JOIN bell b ON b.district_id = d.district_id AND b.year = 1998 LEFT JOIN staff s ON s.district_id = d.district_id"


@query("jn_fanout_views", f"SELECT d.state, count(DISTINCT d.district_id) AS districts, CAST(sum(d.enrollment) AS BIGINT) AS enrollment, round(avg(s.elementary), 4) AS mean {FANOUT} GROUP BY 1")
def _(t):
    d = districts(t).join(bell(t, 1998).select("district_id"), "district_id", "left").join(staff(t), "district_id", "left")
    return d.groupBy("state").agg(F.countDistinct("district_id").alias("districts"), F.sum("enrollment").alias("enrollment"), F.round(F.avg("elementary"), 4).alias("mean"))


@query("jn_fanout_dedup", "SELECT state, count(*) AS districts, CAST(sum(enrollment) AS BIGINT) AS enrollment FROM districts GROUP BY 1")
def _(t):
    return districts(t).groupBy("state").agg(F.count("*").alias("districts"), F.sum("enrollment").alias("enrollment"))


@query("jn_top_view", "SELECT d.district_id, d.enrollment, b.bell_id IS NOT NULL AS enriched, s.elementary FROM districts d LEFT JOIN bell b ON b.district_id = d.district_id AND b.year = 1999 LEFT JOIN staff s ON s.district_id = d.district_id AND s.year = 1999")
def _(t):
    b, s = bell(t, 1999).select("district_id", "bell_id"), staff(t).where("year = 1999").select("district_id", "elementary")
    return districts(t).join(b, "district_id", "left").join(s, "district_id", "left").select("district_id", "enrollment", c("bell_id").isNotNull().alias("enriched"), "elementary")


share("crosswalk", "SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS district_id, 'S' || c_nationkey || '-' || c_custkey AS state_id, n_name AS state FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 4 <> 0")


def crosswalk(t):
    n = F.broadcast(t.nation)  # the states are a fixed list
    x = t.customer.where("c_custkey % 4 <> 0").join(n, c("n_nationkey") == c("c_nationkey"))
    return x.select(F.lpad(c("c_custkey").cast("string"), 7, "0").alias("district_id"), F.concat(F.lit("S"), "c_nationkey", F.lit("-"), "c_custkey").alias("state_id"), c("n_name").alias("state"))


@query("jn_crosswalk_left", "SELECT d.district_id, x.state_id FROM districts d LEFT JOIN crosswalk x ON x.district_id = d.district_id AND x.state = 'NATION_3'")
def _(t):
    return districts(t).join(crosswalk(t).where("state = 'NATION_3'").select("district_id", "state_id"), "district_id", "left").select("district_id", "state_id")


@query("jn_state_views", "SELECT d.district_id, s.year, s.elementary, e.total FROM districts d LEFT JOIN staff s ON s.district_id = d.district_id LEFT JOIN enrollment e ON e.district_id = s.district_id AND e.year = s.year WHERE d.state = 'NATION_4'")
def _(t):
    d = districts(t).where("state = 'NATION_4'").select("district_id").join(staff(t), "district_id", "left")
    return d.join(enrollment(t), ["district_id", "year"], "left").select("district_id", "year", "elementary", "total")


@query("jn_code_bridge", "SELECT x.district_id, CAST(sum(e.total) AS BIGINT) AS total FROM enrollment e JOIN crosswalk x ON x.district_id = e.district_id GROUP BY 1")
def _(t):
    return enrollment(t).join(crosswalk(t), "district_id").groupBy("district_id").agg(F.sum("total").alias("total"))


@query("jn_code_bridge_skipped", "SELECT count(*) AS skipped FROM enrollment WHERE district_id NOT IN (SELECT district_id FROM crosswalk)")
def _(t):
    return absent(enrollment(t), crosswalk(t), ["district_id"]).agg(F.count("*").alias("skipped"))


share("bysource", "SELECT district_id, year, source, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY 1, 2, 3")


def by_source(t):
    return counts(t).groupBy("district_id", "year", "source").agg(F.sum("n").alias("n"))


@query("jn_pd_inner_sfx", "SELECT a.district_id, a.year, a.n AS n_fed, b.n AS n_sea FROM bysource a JOIN bysource b ON a.district_id = b.district_id AND a.year = b.year AND a.source = 'federal' AND b.source = 'state'")
def _(t):
    both = by_source(t).groupBy("district_id", "year").pivot("source", ["federal", "state"]).agg(F.first("n"))  # one scan for both sides
    return both.where("federal is not null and state is not null").select("district_id", "year", c("federal").alias("n_fed"), c("state").alias("n_sea"))


@query("jn_key_intersect", "SELECT district_id FROM bell WHERE year = 1996 INTERSECT SELECT district_id FROM bell WHERE year = 1997")
def _(t):
    return bell(t, 1996).select("district_id").intersect(bell(t, 1997).select("district_id"))


@query("set_intersect", "SELECT district_id FROM staff WHERE year = 1996 INTERSECT SELECT district_id FROM attempts")
def _(t):
    return staff(t).where("year = 1996").select("district_id").intersect(attempts(t).select("district_id"))


@query("jn_3way", "SELECT s.district_id, s.year, d.name, s.elementary + s.kindergarten AS k5_staff, e.total FROM staff s JOIN enrollment e ON e.district_id = s.district_id AND e.year = s.year JOIN districts d ON d.district_id = s.district_id")
def _(t):
    # both sides have a row for each district and year of the counts: one scan gives both
    return staff_and_enrollment(t).join(districts(t), "district_id").select("district_id", "year", "name", (c("elementary") + c("kindergarten")).alias("k5_staff"), "total")


@query("jn_pd_left", "SELECT e.district_id, e.year, e.total, s.paras FROM enrollment e LEFT JOIN staff s ON s.district_id = e.district_id AND s.year = e.year")
def _(t):
    return staff_and_enrollment(t).select("district_id", "year", "total", "paras")


@query("jn_join_outer", "SELECT count(*) AS both, count(*) FILTER (a.prek IS NULL) AS no_prek, round(avg(CAST(a.prek AS DOUBLE) / a.total), 6) AS mean FROM newest a LEFT JOIN staff b ON a.district_id = b.district_id AND a.year = b.year")
def _(t):
    j = newest(t).join(staff(t), ["district_id", "year"], "left")
    return j.agg(F.count("*").alias("both"), F.count_if(c("prek").isNull()).alias("no_prek"), F.round(F.avg(c("prek") / c("total")), 6).alias("mean"))


@query("jn_4way_count", "SELECT count(*) AS n FROM districts d JOIN staff s ON s.district_id = d.district_id JOIN enrollment e ON e.district_id = s.district_id AND e.year = s.year JOIN crosswalk x ON x.district_id = d.district_id")
def _(t):
    return districts(t).join(staff_and_enrollment(t), "district_id").join(crosswalk(t), "district_id").agg(F.count("*").alias("n"))


@query("jn_update_from", "SELECT bell_id, coalesce(x.state_id, b.district_id) AS district_id FROM bell b LEFT JOIN crosswalk x ON x.district_id = b.district_id")
def _(t):
    return bell(t).join(crosswalk(t).select("district_id", "state_id"), "district_id", "left").select("bell_id", F.coalesce("state_id", "district_id").alias("district_id"))


def fuzzy_cascade(wanted, known):
    """(wanted, name, rule): the best match of each wanted name by the first rule that has any.

    Of several names, which the reference leaves open, one with the same first word goes first, then the least.

    Rules in their order: 1 the same name; 2 it is contained; 3 without its endings it is how the name begins (if it has
    such endings); 5 its first two words are; 4 its first word of more than three letters is.  All but the first are
    without regard to case.  All pairs are compared.
    """
    words = F.filter(F.split("wanted", r"\s+"), lambda x: x != "")
    short = T.short_name(c("wanted"))
    w = wanted.select("wanted", F.lower("wanted").alias("__all"), F.when(short != c("wanted"), F.lower(short)).alias("__short"), F.lower(F.when(F.size(words) > 1, F.array_join(F.slice(words, 1, 2), " "))).alias("__two"), F.lower(F.get(words, F.lit(0))).alias("__one"))
    k = known.select("name").where("name is not null").distinct().withColumn("__name", F.lower("name"))
    at = lambda x: c("__name").startswith(c(x))
    rule = F.when(c("wanted") == c("name"), 1).when(c("__name").contains(c("__all")), 2).when(at("__short"), 3).when(at("__two"), 5).when((F.length("__one") > 3) & at("__one"), 4)
    # no equality parts the pairs: a nested loop; only the best of each wanted name goes on
    best = w.crossJoin(k).withColumn("rule", rule).where("rule is not null").groupBy("wanted").agg(F.min(F.struct(F.when(c("rule") == 5, 3.5).otherwise(c("rule")), F.split_part("__name", F.lit(" "), F.lit(1)) != c("__one"), "name", "rule")).alias("m"))
    return best.select("wanted", "m.name", "m.rule")


_SHORT = reduce(lambda x, end: f"regexp_replace({x}, '{end.replace("'", "''")}$', '')", T.SUFFIXES, "trim(wanted)")


@query("jn_fuzzy_cascade", f"""
    WITH w AS (SELECT *, trim({_SHORT}) AS short, list_filter(regexp_split_to_array(wanted, '\\s+'), lambda x: x <> '') AS words FROM (SELECT DISTINCT regexp_replace(p_name, 'widget$', 'wid') AS wanted FROM part)),
    k AS (SELECT DISTINCT p_name AS name FROM part WHERE p_size > 10),
    p AS (SELECT wanted, name, words, CASE WHEN wanted = name THEN 1 WHEN contains(lower(name), lower(wanted)) THEN 2 WHEN short <> wanted AND starts_with(lower(name), lower(short)) THEN 3
                 WHEN len(words) > 1 AND starts_with(lower(name), lower(words[1] || ' ' || words[2])) THEN 5 WHEN length(words[1]) > 3 AND starts_with(lower(name), lower(words[1])) THEN 4 END AS rule FROM w CROSS JOIN k)
    SELECT wanted, name, rule FROM p WHERE rule IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY CASE rule WHEN 5 THEN 3.5 ELSE rule END, split_part(lower(name), ' ', 1) <> lower(words[1]), name) = 1""")
def _(t):
    wanted = t.part.select(F.regexp_replace("p_name", "widget$", "wid").alias("wanted")).distinct()
    return fuzzy_cascade(wanted, t.part.where("p_size > 10").select(c("p_name").alias("name")))


def close_names(wanted, known, cutoff=0.6, top=3):
    """(wanted, name, ratio): the names that are the same, else all that contain the wanted one, both without regard to
    case, else up to `top` of at least the cutoff by difflib's ratio, of equal ones the greater name as there.

    All pairs are compared; difflib's own upper bounds spare most of the full comparisons.
    """
    import difflib

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series, bounded: pd.Series) -> pd.Series:
        out, m = [], difflib.SequenceMatcher()
        for x, y, some in zip(a, b, bounded, strict=True):
            m.set_seq2(x)
            m.set_seq1(y)
            out.append(None if some and (m.real_quick_ratio() < cutoff or m.quick_ratio() < cutoff) else m.ratio())
        return pd.Series(out, dtype="float64")

    w, k = wanted.select("wanted").where("wanted is not null").distinct(), known.select("name").where("name is not null").distinct()
    step = F.when(F.lower("wanted") == F.lower("name"), 1).when(F.lower("name").contains(F.lower("wanted")), 2).otherwise(3)
    least = w.crossJoin(k).groupBy("wanted").agg(F.min(step).alias("step"))  # the step that a name ends with
    p = least.crossJoin(k).where(step == c("step")).withColumn("ratio", ratio("wanted", "name", c("step") == 3)).where((c("step") < 3) | (c("ratio") >= cutoff))
    rank = F.row_number().over(Window.partitionBy("wanted").orderBy(F.desc("ratio"), F.desc("name")))
    return p.withColumn("rank", rank).where((c("step") < 3) | (c("rank") <= top)).select("wanted", "name", F.round("ratio", 6).alias("ratio"))


@query("jn_fuzzy_close")
def _(t):
    return close_names(t.part.select(F.regexp_replace("p_name", "widget$", "wdget").alias("wanted")).distinct(), t.part.select(c("p_name").alias("name")))


@query("agg_coverage", "SELECT count(x.district_id) AS matched, count(*) - count(x.district_id) AS unmatched, round(count(x.district_id) * 100.0 / count(*), 4) AS percent, (SELECT string_agg(district_id, ',' ORDER BY district_id) FROM (SELECT district_id FROM districts WHERE district_id NOT IN (SELECT district_id FROM crosswalk) ORDER BY 1 LIMIT 20)) AS first FROM districts d LEFT JOIN crosswalk x ON x.district_id = d.district_id")
def _(t):
    return coverage(districts(t), crosswalk(t), "district_id")


def sea_selects(t):
    """State files under one shape: each has a column name of its own for staff."""
    s = staff(t)
    parts = [s.where(c("year") == y).select(F.lit(f"S{y}").alias("state"), "district_id", c(col).cast("double").alias("fte"), "year") for y, col in ((1996, "elementary"), (1997, "secondary"), (1998, "paras"))]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("i_sea_select", "SELECT 'S' || year AS state, district_id, CAST(CASE year WHEN 1996 THEN elementary WHEN 1997 THEN secondary ELSE paras END AS DOUBLE) AS fte, year FROM staff WHERE year IN (1996, 1997, 1998)")
def _(t):
    return sea_selects(t)
