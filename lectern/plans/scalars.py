"""Scalar functions over literal rows, and over the tables where they have such values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as T
from .model import attempts
from .registry import query, scalar

S = "x string"


def _s(*values):
    return [(v,) for v in values]


# ---- strings
scalar("s_state", S, _s("California", " texas ", "ny", "ZZ", "Puerto Rico", None, "dc"), T.state_code, "CASE lower(trim(x)) WHEN 'california' THEN 'CA' WHEN 'texas' THEN 'TX' WHEN 'ny' THEN 'NY' WHEN 'dc' THEN 'DC' END")
scalar("s_state_name", S, _s("CA", "wv", "PR", None), T.state_name, "CASE upper(trim(x)) WHEN 'CA' THEN 'California' WHEN 'WV' THEN 'West Virginia' END")
scalar("s_fmt_num", "x double", [(1234567.0,), (12.0,), (0.0,), (None,), (-98765.0,)], T.thousands, "coalesce(format('{:,}', CAST(x AS BIGINT)), 'N/A')")
scalar("s_id_strip", S, _s("0012", "000", "7", "", None), T.strip_zeros, "coalesce(nullif(ltrim(x, '0'), ''), x)")
scalar("s_id_pad", S, _s("12", " 123 ", "12345678", None, ""), lambda x: T.zero_fill(x, 7), "CASE WHEN length(trim(x)) >= 7 THEN trim(x) ELSE lpad(trim(x), 7, '0') END")
scalar("s_id_int", S, _s("0012", "7", "x", None), T.as_integer_text, "CAST(TRY_CAST(x AS BIGINT) AS VARCHAR)")
scalar(
    "s_state_ids", "state string, x string", [("FL", "7"), ("VA", "7"), ("IL", "01-234-5678-90"), ("MA", "350000"), ("MI", "01010"), ("PA", "0012"), ("TX", " 057905 "), ("NY", None), ("IL", "123")], T.state_district_id,
    """CASE state WHEN 'FL' THEN lpad(CAST(TRY_CAST(x AS BIGINT) AS VARCHAR), 2, '0') WHEN 'VA' THEN lpad(CAST(TRY_CAST(x AS BIGINT) AS VARCHAR), 3, '0')
       WHEN 'IL' THEN CASE WHEN length(regexp_replace(x, '[^0-9]', '', 'g')) >= 11 THEN regexp_replace(regexp_replace(x, '[^0-9]', '', 'g'), '^(..)(...)(....)(..).*$', '\\1-\\2-\\3-\\4') END
       WHEN 'MA' THEN left(lpad(x, 8, '0'), 4) WHEN 'MI' THEN CAST(TRY_CAST(x AS BIGINT) AS VARCHAR) WHEN 'PA' THEN CAST(TRY_CAST(x AS BIGINT) AS VARCHAR) ELSE trim(x) END""",
)
scalar("s_stleaid", S, _s("CA-1234567", "TX-9", "AB", "A-B", "A-BC-D", None), T.after_dash, "CASE WHEN x LIKE '%-%' AND length(x) > 3 THEN substr(x, instr(x, '-') + 1) END")
scalar("s_cds", S, _s("CA-0161119", "01611190130229", "123", "abcdefg", None, " 0161119 "), T.county_district_code, "CASE WHEN regexp_full_match(left(regexp_replace(trim(x), '^CA-', ''), CASE WHEN length(regexp_replace(trim(x), '^CA-', '')) = 14 THEN 7 ELSE 99 END), '[0-9]{7}') THEN left(regexp_replace(trim(x), '^CA-', ''), 7) END")
scalar("s_cds_valid", S, _s("0161119", "01611190130229", "016111", "0161119x", None), T.valid_county_code, "coalesce(regexp_full_match(trim(x), '[0-9]{7}|[0-9]{14}'), false)")
scalar("s_cds_pack", S, _s("0161119", None), lambda x: F.concat(F.lit("CA-"), x), "'CA-' || x")
scalar("s_cds_parts", S, _s("0161119", "1999999", None), lambda x: F.concat_ws("/", *T.county_parts(x)), "CASE WHEN x IS NULL THEN '' ELSE substr(x, 1, 2) || '/' || substr(x, 3, 5) END")
scalar("s_cds_build", "county string, district string", [("1", "61119"), ("19", "64"), (None, "1")], T.build_county_code, "lpad(trim(county), 2, '0') || lpad(trim(district), 5, '0')")
scalar("s_url_norm", S, _s(" www.a.org/ ", "http://b.org//", "N/A", "", None, "https://c.org/x"), T.normal_url, "regexp_replace(CASE WHEN upper(trim(x)) IN ('', 'M', 'N', 'NULL', 'NONE', 'NAN', 'N/A') THEN NULL WHEN regexp_matches(trim(x), '^(?i)https?://') THEN trim(x) ELSE 'https://' || trim(x) END, '/+$', '')")
scalar("s_grade_norm", S, _s("pk", "5", " 11 ", "M", "", None, "kg"), T.normal_grade, "CASE WHEN upper(trim(x)) IN ('', 'M', 'N', 'NULL', 'NONE', 'NAN', 'N/A') THEN NULL WHEN regexp_full_match(trim(x), '[0-9]') THEN lpad(trim(x), 2, '0') ELSE upper(trim(x)) END")
scalar("s_suffix_strip", S, _s("Oak School District", "Elm Unified School District", "Ash County Schools", "Ivy City ISD", "Plain", None), T.short_name, "CASE x WHEN 'Oak School District' THEN 'Oak' WHEN 'Elm Unified School District' THEN 'Elm' WHEN 'Ash County Schools' THEN 'Ash' WHEN 'Ivy City ISD' THEN 'Ivy City' ELSE x END")
scalar("s_sanitize", S, _s("it's <b>fine</b>; drop  table x", "plain", None, "Select all"), T.sanitized, "trim(regexp_replace(regexp_replace(regexp_replace(left(x, 500), '[<>;''\"\\\\`]', '', 'g'), '(?i)\\b(?:select|insert|update|delete|drop|union|alter|create|exec)\\b', '[FILTERED]', 'g'), '\\s+', ' ', 'g'))")
scalar("s_notes_join", "notes string, a string, b string", [("old", "B", "A"), ("", "A", "A"), (None, None, None), ("n", None, "C")], lambda n, a, b: T.joined_notes(n, F.array_compact(F.array(a, b))), "concat_ws('; ', nullif(notes, ''), nullif(array_to_string(list_sort(list_distinct([a, b])), '; '), ''))")
scalar("s_ratio_parse", S, _s("11.3 to 1", "9 to 1", "x to 1", None), T.ratio_number, "TRY_CAST(trim(split_part(x, 'to', 1)) AS DOUBLE)")
scalar("s_clean_num", S, _s("1,234.5", " 7 ", "n/a", None), lambda x: F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("double"), "TRY_CAST(replace(trim(x), ',', '') AS DOUBLE)")
scalar("s_safe_dir", S, _s("A b/c!", "x" * 60, None), T.safe_folder, "left(regexp_replace(x, '[^A-Za-z0-9]', '_', 'g'), 50)")
scalar("s_block_type", "message string, code int", [("Cloudflare ray", 503), ("solve the CAPTCHA", 200), ("WAF", 200), ("no", 403), ("fine", 200), (None, None)], T.block_type, "CASE WHEN lower(message) LIKE '%cloudflare%' THEN 'cloudflare' WHEN lower(message) LIKE '%captcha%' THEN 'captcha' WHEN lower(message) LIKE '%waf%' OR code = 403 THEN 'waf' END")
scalar("s_status_map", S, _s("BLOCKED", "NOT_FOUND", "OK", "?", None), lambda x: T.attempt_status(x, {"BLOCKED": "blocked", "NOT_FOUND": "not_found", "OK": "success"}), "CASE x WHEN 'BLOCKED' THEN 'blocked' WHEN 'NOT_FOUND' THEN 'not_found' WHEN 'OK' THEN 'success' ELSE 'error' END")
scalar("s_fail_pattern", S, _s("Timeout after 30s", "HTTP 404", "Blocked by captcha", "parse failure", None), T.failure_pattern, "CASE WHEN x IS NULL THEN 'other' WHEN lower(x) LIKE '%timeout%' THEN 'timeout' WHEN lower(x) LIKE '%404%' OR lower(x) LIKE '%not found%' THEN 'not_found' WHEN lower(x) LIKE '%block%' OR lower(x) LIKE '%captcha%' THEN 'blocked' WHEN lower(x) LIKE '%parse%' THEN 'parse_error' ELSE 'other' END")
scalar("s_group_key", "a string, b string", [("wordpress-site", "pdf"), (None, "html"), ("x", None)], T.group_key, "left(coalesce(a, 'unknown'), 10) || '_' || left(coalesce(b, 'unknown'), 10)")


@query("s_filename", """
    SELECT page_id, 'page_' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || '_' || left(coalesce(nullif(regexp_replace(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '[^A-Za-z0-9]+', '_', 'g'), ''), 'index'), 50) AS file
    FROM pages""")
def _(t):
    return t.pages.select("page_id", T.safe_file_name(T.path(F.col("url")), F.col("page_id") % 1000).alias("file"))


# ---- numbers
scalar("n_safe_float", S, _s("1.5", "*", "", " 7 ", "n/a", "x", "1e3", None), N.safe_float, "CASE WHEN trim(x) NOT IN ('', '*', '-', '--', 'N/A', 'n/a', 'NA', 'null', 'NULL') THEN TRY_CAST(trim(x) AS DOUBLE) END")
scalar("n_safe_int", S, _s("8.7", "-8.7", "*", "12", "x", None), N.safe_int, "CASE WHEN trim(x) <> '*' THEN CAST(trunc(TRY_CAST(trim(x) AS DOUBLE)) AS BIGINT) END")
scalar("n_safe_pct", S, _s("50", "12.5", "*", None), N.safe_percent, "CASE WHEN trim(x) <> '*' THEN TRY_CAST(trim(x) AS DOUBLE) / 100 END")
scalar("n_safe_float_csv", S, _s("1,234", "–", "-", "9.5", None), N.float_with_commas, "TRY_CAST(replace(trim(x), ',', '') AS DOUBLE)")
scalar("n_safe_divide", "a double, b double", [(1.0, 4.0), (1.0, 0.0), (None, 2.0), (3.0, None)], N.safe_divide, "coalesce(a / nullif(b, 0), 0)")
scalar("n_to_numeric", S, _s("12", "1.5", "abc", "", None), lambda x: x.try_cast("double"), "TRY_CAST(x AS DOUBLE)")
scalar("n_clamp", "x double", [(-0.5,), (0.25,), (1.5,), (None,)], N.clamp, "CASE WHEN x < 0 OR x IS NULL THEN 0.0 WHEN x > 1 THEN 1.0 ELSE x END")
scalar("n_backoff", "k int", [(i,) for i in range(1, 7)], N.backoff_ms, "CAST(least(1000 * power(2, k - 1), 8000) AS BIGINT)")
scalar("n_weight_combo", "m double, p double", [(0.5, 0.25), (None, 0.5), (1.0, 0.0)], N.combine_scores, "CASE WHEN m IS NULL THEN p ELSE 0.7 * m + (1 - 0.7) * p END")
scalar("n_tolerance", "a double, e double", [(100.0, 104.0), (100.0, 106.0), (0.0, 0.0), (1.0, 0.0)], lambda a, e: N.within_tolerance(a, e, 5), "CASE WHEN e = 0 THEN a = 0 ELSE abs(a - e) * 100 <= abs(e) * 5 END")


@query("n_poisson_ci", """
    WITH c AS (SELECT district_id, count(*) AS n FROM attempts GROUP BY 1)
    SELECT district_id, n, greatest(CAST(trunc(n - 1.96 * sqrt(n)) AS BIGINT), 0) AS low, CAST(ceil(n + 1.96 * sqrt(n)) AS BIGINT) AS high FROM c""")
def _(t):
    low, high = N.count_interval(F.col("n"))
    return attempts(t).groupBy("district_id").agg(F.count("*").alias("n")).select("district_id", "n", low.alias("low"), high.alias("high"))


scalar("n_poisson_zero", "n int", [(0,), (1,), (9,)], lambda n: N.count_interval(n)[1], "CASE WHEN n = 0 THEN 3 ELSE CAST(ceil(n + 1.96 * sqrt(n)) AS BIGINT) END")
scalar(
    "n_discrepancy", "claimed int, actual int", [(100, 100), (100, 115), (100, 130), (100, 250), (0, 0), (0, 5), (5, 0)], lambda c, a: F.concat_ws(":", N.discrepancy(c, a)["severity"], F.format_string("%.4f", N.discrepancy(c, a)["percent"])),
    "CASE WHEN claimed = 0 AND actual = 0 THEN 'info:0.0000' WHEN claimed = 0 THEN 'critical:100.0000' ELSE CASE WHEN actual = 0 THEN 'critical' WHEN actual BETWEEN greatest(trunc(claimed - 1.96 * sqrt(claimed)), 0) AND ceil(claimed + 1.96 * sqrt(claimed)) THEN 'info' WHEN actual > 2 * claimed OR 2 * actual < claimed THEN 'critical' ELSE 'warning' END || ':' || format('{:.4f}', abs(actual - claimed) * 100.0 / claimed) END",
)


@query("n_hash", "SELECT left(md5((SELECT count(*) FROM customer) || ':' || (SELECT count(*) FROM orders)), 16) AS hash")
def _(t):
    c, o = t.customer.agg(F.count("*").alias("c")), t.orders.agg(F.count("*").alias("o"))
    return c.crossJoin(o).select(N.input_hash(F.col("c").cast("string"), F.col("o").cast("string")).alias("hash"))  # one row each


# ---- school years and clock times
scalar("d_year_num", S, _s("2023-24", "19", "", "abcd-1", None), D.start_year, "TRY_CAST(substr(x, 1, 4) AS INTEGER)")
scalar("d_year_span", "a string, b string", [("2023-24", "2019-20"), ("2019-20", "2023-24"), (None, "2020-21")], D.year_span, "abs(TRY_CAST(left(a, 4) AS INTEGER) - TRY_CAST(left(b, 4) AS INTEGER))")
_Y = [("2023-24", "2021-22", "2020-21"), ("2023-24", None, "2019-20"), (None, None, "2020-21"), (None, None, None)]
_SPAN = "coalesce(list_max([TRY_CAST(left(a, 4) AS INTEGER), TRY_CAST(left(b, 4) AS INTEGER), TRY_CAST(left(c, 4) AS INTEGER)]) - list_min([TRY_CAST(left(a, 4) AS INTEGER), TRY_CAST(left(b, 4) AS INTEGER), TRY_CAST(left(c, 4) AS INTEGER)]), 0)"
scalar("d_window3", "a string, b string, c string", _Y, D.in_window, f"{_SPAN} <= 3")
scalar("d_span_list", "a string, b string, c string", _Y, D.span_of, _SPAN)
scalar("set_union_unnest", "a string, b string, c string", _Y, D.span_of, _SPAN)
scalar("d_flags", "span int, base boolean", [(0, False), (2, False), (3, True), (5, True), (None, False)], lambda s, b: F.array_join(D.temporal_flags(s, b), ","), "concat_ws(',', CASE WHEN span BETWEEN 2 AND 3 THEN 'WARN_YEAR_GAP' END, CASE WHEN span > 3 THEN 'ERR_SPAN_EXCEEDED' END, CASE WHEN base THEN 'INFO_RATIO_BASELINE' END)")
scalar("d_time_min", S, _s("8:05 AM", "12:00 AM", "12:30 pm", "3:15 PM", "15:00", "8:05", None), D.clock_minutes, "CASE WHEN regexp_matches(x, '(?i)^\\s*\\d{1,2}:\\d{2}\\s*(AM|PM)\\s*$') THEN (CAST(regexp_extract(x, '(\\d{1,2}):', 1) AS INTEGER) % 12 + CASE WHEN upper(x) LIKE '%PM%' THEN 12 ELSE 0 END) * 60 + CAST(regexp_extract(x, ':(\\d{2})', 1) AS INTEGER) END")
_LENIENT = "CASE WHEN regexp_matches({0}, '^\\s*\\d{{1,2}}:\\d{{2}}') THEN (CASE WHEN upper({0}) LIKE '%AM%' OR upper({0}) LIKE '%PM%' THEN CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) % 12 + CASE WHEN upper({0}) LIKE '%PM%' THEN 12 ELSE 0 END ELSE CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) END) * 60 + CAST(regexp_extract({0}, ':(\\d{{2}})', 1) AS INTEGER) END"
scalar("d_time_parse", S, _s("8:05", "3:15 PM", "12:10 am", "noon", None), D.clock_minutes_lenient, _LENIENT.format("x"))
scalar("d_time_norm", S, _s("8:05 a.m.", "3:15 p.m.", "7:45", "2:30", "12:00", "none", None), D.normal_time, "CASE x WHEN '8:05 a.m.' THEN '8:05 AM' WHEN '3:15 p.m.' THEN '3:15 PM' WHEN '7:45' THEN '7:45 AM' WHEN '2:30' THEN '2:30 PM' WHEN '12:00' THEN '12:00 PM' END")
_D = [("8:00 AM", "3:00 PM"), ("10:00 PM", "6:00 AM"), ("8:15", "14:45"), ("x", "3:00 PM"), (None, None)]
scalar("d_minutes_diff", "a string, b string", _D, D.minutes_between, f"((({_LENIENT.format('b')}) - ({_LENIENT.format('a')})) % 1440 + 1440) % 1440")
scalar("d_minutes_pdf", "a string, b string", _D, D.minutes_between_or_zero, f"coalesce(((({_LENIENT.format('b')}) - ({_LENIENT.format('a')})) % 1440 + 1440) % 1440, 0)")
scalar("d_staleness", S, _s("2025-26", "2020-21", "2015-16", "bad", None), lambda x: D.staleness(x, 2025), "CASE WHEN TRY_CAST(left(x, 4) AS INTEGER) IS NULL THEN 'UNKNOWN' WHEN x IN ('2019-20', '2020-21', '2021-22', '2022-23') THEN 'COVID' WHEN 2025 - TRY_CAST(left(x, 4) AS INTEGER) > 3 THEN 'STALE' ELSE 'CURRENT' END")


@query("d_utc_stamp", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def _(t):
    return t.events.select("event_id", D.utc_stamp(F.col("ts")).alias("stamp"))


@query("d_date_series", """
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day, count(event_id) AS n FROM range(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-06', INTERVAL 1 DAY) r(d) LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def _(t):
    days = t.spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit("2023-12-25")), F.to_date(F.lit("2024-02-05")))).alias("day"))
    n = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.join(n, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


# ---- arrays, maps, JSON
scalar("a_append_once", "x string, f string", [("A,B", "B"), ("A", "C"), (None, "D")], lambda x, f: F.array_join(F.when(F.array_contains(F.coalesce(F.split(x, ","), F.array().cast("array<string>")), f), F.split(x, ",")).otherwise(F.array_append(F.coalesce(F.split(x, ","), F.array().cast("array<string>")), f)), ","), "CASE WHEN x IS NULL THEN f WHEN list_contains(string_split(x, ','), f) THEN x ELSE x || ',' || f END")
_LO, _HI = "CASE lo WHEN 'PK' THEN -1 WHEN 'KG' THEN 0 ELSE TRY_CAST(lo AS INTEGER) END", "CASE hi WHEN 'PK' THEN -1 WHEN 'KG' THEN 0 ELSE TRY_CAST(hi AS INTEGER) END"


def grade_number(x):
    return F.when(F.upper(x) == "PK", -1).when(F.upper(x) == "KG", 0).otherwise(x.try_cast("int"))


def grade_levels(lo, hi):
    """The levels that a span of grades touches; all of them where an end is unknown."""
    a, b = grade_number(lo), grade_number(hi)
    some = F.array_compact(F.array(F.when(a <= 5, "elementary"), F.when((a <= 8) & (b >= 6), "middle"), F.when(b >= 9, "high")))
    return F.when(a.isNull() | b.isNull(), F.array(F.lit("elementary"), F.lit("middle"), F.lit("high"))).otherwise(some)


_LEVELS = f"CASE WHEN ({_LO}) IS NULL OR ({_HI}) IS NULL THEN 'elementary,middle,high' ELSE concat_ws(',', CASE WHEN ({_LO}) <= 5 THEN 'elementary' END, CASE WHEN ({_LO}) <= 8 AND ({_HI}) >= 6 THEN 'middle' END, CASE WHEN ({_HI}) >= 9 THEN 'high' END) END"
_SPANS = [("PK", "05"), ("KG", "12"), ("06", "08"), ("09", "12"), (None, "12"), ("07", "07"), ("UG", "UG")]
scalar("prj_grade_span", "lo string, hi string", _SPANS, lambda a, b: F.array_join(F.when(F.size(grade_levels(a, b)) == 0, F.array(F.lit("high"))).otherwise(grade_levels(a, b)), ","), _LEVELS)
scalar("a_grade_levels", "lo string, hi string", _SPANS, lambda a, b: F.array_join(grade_levels(a, b), ","), _LEVELS)
scalar("a_levels_range", S, _s("K-8", "k-12", "9-12", "K-5", "K-6", "?", None), lambda x: F.when(F.lower(x).contains("k-8"), "elementary,middle").when(F.lower(x).contains("k-12"), "elementary,middle,high").when(x.contains("9-12"), "high").when(F.lower(x).rlike("k-[56]"), "elementary").otherwise("elementary,middle,high"), "CASE lower(x) WHEN 'k-8' THEN 'elementary,middle' WHEN 'k-12' THEN 'elementary,middle,high' WHEN '9-12' THEN 'high' WHEN 'k-5' THEN 'elementary' WHEN 'k-6' THEN 'elementary' ELSE 'elementary,middle,high' END")
scalar("m_category_map", S, _s("Teachers", "Paraprofessionals", "Cooks", None), lambda x: T.lookup({"Teachers": "teachers_total", "Paraprofessionals": "paras"}, x), "CASE x WHEN 'Teachers' THEN 'teachers_total' WHEN 'Paraprofessionals' THEN 'paras' END")
scalar("m_method_map", S, _s("manual", "pdf", "other", None), lambda x: T.lookup({"manual": "human_provided", "pdf": "pdf_text"}, x, x), "CASE x WHEN 'manual' THEN 'human_provided' WHEN 'pdf' THEN 'pdf_text' ELSE x END")


@query("a_unnest", """
    SELECT DISTINCT district_id, 1 AS tier, 'pending' AS status FROM (SELECT unnest([lpad(CAST(n_nationkey AS VARCHAR), 7, '0'), lpad(CAST(n_nationkey * 7 AS VARCHAR), 7, '0')]) AS district_id FROM nation)
    WHERE district_id NOT IN (SELECT district_id FROM attempts WHERE skip)""")
def _(t):
    from ..operators.queue import enqueue

    ids = t.nation.select(F.explode(F.array(F.lpad(F.col("n_nationkey").cast("string"), 7, "0"), F.lpad((F.col("n_nationkey") * 7).cast("string"), 7, "0"))).alias("district_id"))
    return enqueue(ids, attempts(t).where("skip"))


@query("j_get", "SELECT event_id, coalesce(nullif(CAST(json_extract_string(props, '$.total') AS INTEGER), 0), CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.coalesce(F.nullif(F.get_json_object("props", "$.total").try_cast("int"), F.lit(0)), F.get_json_object("props", "$.k").try_cast("int"), F.lit(0)).alias("k"))


scalar("j_extract", S, _s('```json\n{"a": 1}\n```', 'text [1, 2] more', "none", None), lambda x: F.nullif(F.regexp_extract(x, r"(?s)(\[.*\]|\{.*\})", 1), F.lit("")), "nullif(regexp_extract(x, '(?s)(\\[.*\\]|\\{.*\\})', 1), '')")


@query("j_rankings", """
    SELECT url, least(greatest(score, 0), 1) AS score FROM (VALUES ('http://a/1', 0.5), ('http://a/2', 1.5)) v(url, score)""")
def _(t):
    from ..operators.pages import rankings

    reply = t.values("body string", ('[{"url": "http://a/1", "score": 0.5, "reason": "r"}, {"url": "http://a/2", "score": 1.5}, {"url": "http://x", "score": 0.1}]',))
    return rankings(reply, t.values("url string", ("http://a/1",), ("http://a/2",), ("http://a/3",))).select("url", "score")


@query("j_override", """
    SELECT event_type AS override_type, count(*) AS n, round(count(*) / 30.0, 4) AS per_day, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy(F.col("event_type").alias("override_type")).agg(F.count("*").alias("n"), F.round(F.count("*") / 30.0, 4).alias("per_day"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("k"))


@query("j_cast_jsonb", "SELECT event_id, json_extract_string(CAST(props AS JSON), '$.k') AS k FROM events")
def _(t):
    return t.events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "string").alias("k"))
