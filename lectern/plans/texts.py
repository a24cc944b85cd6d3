"""Text, HTML and URL operators over pages, documents and literal texts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators import pages as P
from ..operators.relational import latest_per_key, top_per_group
from .model import districts
from .registry import SHARED, query, scalar, share

c = F.col
S = "x string"


def _s(*values):
    return [(v,) for v in values]


TEXTS = [
    (1, "Bell Schedule\n| School | Start | End |\n|---|---|---|\n| Oak Elementary | 8:00 AM | 2:30 PM |\n| Elm Middle | 8:15 AM | 3:00 PM |\n| Ash High | 7:30 AM | 2:45 PM |\n| Ivy High | 7:00 AM | 2:00 PM |"),
    (2, "Our high school day runs 8:10 AM - 3:10 PM.\nLunch at noon."),
    (3, "Elementary 8:30 AM to 3:00 PM\nElementary 8:30 AM to 3:00 PM\nMiddle 9:00 AM, 12:00 PM, 3:45 PM"),
    (4, "No times here\n| a |\n| b |"),
    (7, "School | Hours\n---|---\nOak Primary | 8:00-2:30 | 1:00-2:00\nAsh | 7:25 a.m. to 2:05 p.m.\nElm junior high | 9:00 AM - 9:30 PM\nElm 6-8 | 8:15 – 3:00\n\nend\n| x |\n| - |\n| Ivy high 07:00am-2:00pm | 1 |\n| K5: 8:05 AM to 2:35 PM |"),
    (8, "a | b\n8:00-3:00 | high\nx | Senior 8:00-3:00"),
    (9, "Bell schedule. Start time 8:00 AM, dismissal 3:00 PM. Period 1 8:00, Period 2 8:50, period 3 9:40, period4 10:30, 1st period, 11:20 12:10 1:00 p.m."),
    (10, "School hours " + " ".join(f"{h}:{m:02}" for h in range(8, 12) for m in range(0, 60, 10))),
    (5, ""),
    (6, None),
]


def texts(t):
    return t.values("doc_id int, text string", *TEXTS)


def _v(rows) -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


share("texts", f"SELECT * FROM (VALUES {_v(TEXTS)}) v(doc_id, text)")
share("textlines", "SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM texts WHERE text IS NOT NULL)")
LEVEL = "CASE WHEN regexp_matches({0}, '(?i)\\b(?:elementary|primary|k-5|k-6)\\b') THEN 'elementary' WHEN regexp_matches({0}, '(?i)\\b(?:middle|junior|6-8|7-8)\\b') THEN 'middle' WHEN regexp_matches({0}, '(?i)\\b(?:high|senior|9-12)\\b') THEN 'high' END"
TIME = r"\d{1,2}:\d{2}\s*(?:AM|PM|am|pm|a\.m\.|p\.m\.)?"
_CLOCK = "((CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) % 12 + CASE WHEN upper({0}) LIKE '%PM%' THEN 12 ELSE 0 END) * 60 + CAST(regexp_extract({0}, ':(\\d{{2}})', 1) AS INTEGER))"
_ROW_LEVEL = "CASE " + " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{n}'" for n, p in P.ROW_LEVELS) + " ELSE 'high' END"
share("tablecells", """
    SELECT doc_id, pos, line, trim(unnest(string_split(line, '|'))) AS cell, unnest(range(len(string_split(line, '|')))) AS nth
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS place, count(*) OVER (PARTITION BY doc_id, island) AS size
    FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM textlines WHERE contains(line, '|'))) WHERE size >= 3 AND place > 2""")
_MARKED = "regexp_replace(regexp_replace(regexp_replace(trim({0}), '(?i)a\\.m\\.|am', 'AM', 'g'), '(?i)p\\.m\\.|pm', 'PM', 'g'), '(\\d)(AM|PM)', '\\1 \\2', 'g')"
_HALF = "{0} || CASE WHEN regexp_matches({0}, 'AM|PM') THEN '' WHEN CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) BETWEEN 6 AND 11 THEN ' AM' WHEN CAST(regexp_extract({0}, '(\\d{{1,2}}):', 1) AS INTEGER) IN (1, 2, 3, 4, 5, 12) THEN ' PM' ELSE '' END"
share("celltimes", f"SELECT doc_id, level, {_HALF.format('s')} AS start, {_HALF.format('e')} AS stop FROM (SELECT doc_id, pos, nth, {_ROW_LEVEL} AS level, {_MARKED.format(f"regexp_extract(cell, '{P.CELL_RANGE}', 1)")} AS s, {_MARKED.format(f"regexp_extract(cell, '{P.CELL_RANGE}', 2)")} AS e FROM tablecells WHERE regexp_matches(cell, '{P.CELL_RANGE}')) QUALIFY row_number() OVER (PARTITION BY doc_id, level ORDER BY pos, nth) = 1")
share("fromtables", f"SELECT * FROM (SELECT doc_id, level, start, stop, ({_CLOCK.format('stop')} - {_CLOCK.format('start')} + 1440) % 1440 AS minutes FROM celltimes) WHERE minutes BETWEEN 240 AND 540")


def table_schedules(docs):
    """(doc_id, level, start, stop, minutes): the first time range in a cell of each level's rows, if it lasts 240 to 540 minutes."""
    part = lambda i: D.marked_time(F.regexp_extract("cell", P.CELL_RANGE, i))
    r = P.table_cells(docs).where(c("cell").rlike(P.CELL_RANGE)).select("doc_id", "pos", "at", P.row_level(c("line")).alias("level"), part(1).alias("start"), part(2).alias("stop"))
    first = latest_per_key(r, ["doc_id", "level"], [c("pos"), c("at")]).drop("pos", "at")
    return first.withColumn("minutes", D.minutes_between(c("start"), c("stop"))).where("minutes between 240 and 540")


@query("tx_table", "SELECT * FROM fromtables")
def _(t):
    return table_schedules(texts(t))


_RANGE = r"(\d{1,2}:\d{2} *[AP]M) *(?:-|to) *(\d{1,2}:\d{2} *[AP]M)"
share("fromregex", f"SELECT doc_id, coalesce({LEVEL.format('text')}, 'high') AS level, start, stop, {_CLOCK.format('stop')} - {_CLOCK.format('start')} AS minutes FROM (SELECT doc_id, text, regexp_extract(text, '{_RANGE}', 1) AS start, regexp_extract(text, '{_RANGE}', 2) AS stop FROM texts WHERE regexp_matches(text, '{_RANGE}')) WHERE {_CLOCK.format('stop')} - {_CLOCK.format('start')} BETWEEN 240 AND 540")


def regex_schedules(docs):
    r = docs.where(c("text").rlike(_RANGE)).select("doc_id", P.level_of(c("text")).alias("level"), F.regexp_extract("text", _RANGE, 1).alias("start"), F.regexp_extract("text", _RANGE, 2).alias("stop"))
    return r.withColumn("minutes", D.clock_minutes_lenient(c("stop")) - D.clock_minutes_lenient(c("start"))).where("minutes between 240 and 540")


@query("tx_regex", "SELECT * FROM fromregex")
def _(t):
    return regex_schedules(texts(t))


share("parsed", "SELECT *, 'table' AS method FROM fromtables UNION ALL SELECT r.*, 'regex' FROM fromregex r WHERE NOT EXISTS (SELECT 1 FROM fromtables f WHERE f.doc_id = r.doc_id AND f.level IS NOT DISTINCT FROM r.level)")


def parsed(docs):
    """Schedules from tables, and from running text for levels that no table has."""
    a, b = table_schedules(docs), regex_schedules(docs)
    seen = a.select(c("doc_id").alias("d"), c("level").alias("l"))
    return a.withColumn("method", F.lit("table")).unionByName(b.join(seen, (c("doc_id") == c("d")) & c("level").eqNullSafe(c("l")), "left_anti").withColumn("method", F.lit("regex")))


@query("tx_parse_all", "SELECT * FROM parsed WHERE level IN ('high', 'middle')")
def _(t):
    return parsed(texts(t)).where(c("level").isin("high", "middle"))


_ORDER = "CASE level WHEN 'high' THEN 1 WHEN 'middle' THEN 2 ELSE 3 END"


def preferred(rows):
    return latest_per_key(rows, ["doc_id"], [F.when(c("level") == "high", 1).when(c("level") == "middle", 2).otherwise(3), c("start")])


@query("tx_prefer", f"SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {_ORDER}, start) = 1")
def _(t):
    return preferred(parsed(texts(t)))


@query("tx_level", f"SELECT doc_id, coalesce({LEVEL.format('text')}, 'high') AS level FROM documents")
def _(t):
    return t.documents.select("doc_id", P.level_of(c("text")).alias("level"))


share("pdflines", f"""
    SELECT doc_id, level, start, stop FROM (SELECT doc_id, {LEVEL.format('line')} AS level, trim(regexp_extract_all(line, '{TIME}')[1]) AS start, trim(regexp_extract_all(line, '{TIME}')[-1]) AS stop FROM textlines WHERE len(regexp_extract_all(line, '{TIME}')) >= 2) GROUP BY ALL""")


@query("tx_pdf_lines", "SELECT * FROM pdflines")
def _(t):
    return P.schedule_lines(texts(t)).select("doc_id", "level", "start", c("end").alias("stop"))


@query("tx_pdf_level", f"SELECT doc_id, pos, {LEVEL.format('line')} AS level FROM (SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))")
def _(t):
    return P.lines(t.documents).select("doc_id", "pos", P.level_of(c("line"), None).alias("level"))


#: Pages of the kinds that the table hasn't, beside it.
ODD_PAGES = [
    (-1, "https://a.org/Bell-Schedule/parents/hours_of_operation.html", "<html><head><title>Bell <b>times</b></title><META content='All about <x> times' name=\"description\"></head><body><ol class=\"x breadcrumb\"><li>Home</li>\n <li>Bell</li></ol><h1> Start\ntimes </h1><a href='/f/bell.pdf?v=1'>The <i>schedule</i></a><a id=1 href=/school/x>Oak Elem</a><a name='no'>school</a> 8:00 AM 3:10pm start time end period 1 period 2 period 3 period 4 bell schedule 1:00 1:01 1:02 1:03 1:04</body></html>"),
    (-2, "https://a.org/news/school_day-calendar?x=bell", "<nav aria-label='Breadcrumb trail'>a &gt; b</nav><a href=\"x.pdf\">menu</a><a HREF=\"https://b.org/Schools/\">Elm Junior</a><A href='#'>Senior SCHOOL</A>"),
    (-3, "https://b.org/sports/arrival;p=1/dismissal", None),
    (-4, "no-url/tests", ""),
    (-5, None, "<p>school hours 8:00</p>"),
    (-6, "https://a.org/blog/school-hours/start_time/daily-schedule/about/schedule information/bellschedule/calendar", "<body>School hours start time dismissal 8:00 8:01 8:02 8:03 8:04 8:05</body>"),
    (-7, "https://a.org/x/lunch-games_bellx.aspx", "<body></body>"),
]
share("allpages", f"SELECT page_id, url, html FROM pages UNION ALL SELECT * FROM (VALUES {_v(ODD_PAGES)}) v(page_id, url, html)")


def all_pages(t):
    return t.pages.select("page_id", "url", "html").unionByName(t.values("page_id bigint, url string, html string", *ODD_PAGES))


def _q(pattern):
    return "'" + pattern.replace("'", "''") + "'"


def _either(text, pattern, groups):
    return "concat(" + ", ".join(f"regexp_extract({text}, {_q(pattern)}, {i + 1})" for i in range(groups)) + ")"


_TEXT = "trim(regexp_replace(regexp_replace(regexp_replace({0}, '(?is)<(?:script)\\b.*?</script>|<(?:style)\\b.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
_VISIBLE = _TEXT.format("CASE WHEN regexp_extract(html, '(?is)<body\\b[^>]*>(.*)', 1) <> '' THEN regexp_extract(html, '(?is)<body\\b[^>]*>(.*)', 1) ELSE html END")
_ELEMENT = "trim(regexp_replace(regexp_extract(html, '(?is)<{0}\\b[^>]*>(.*?)</{0}>', 1), '(?s)<[^>]+>', ' ', 'g'))"
_PLAIN = "trim(regexp_replace({0}, '(?s)<[^>]+>', '', 'g'))"
_PDF = f"len(list_filter(regexp_extract_all(html, {_q(P.ANCHOR)}), lambda x: regexp_matches({_either('x', P.HREF, 3)}, '{P.PDF_LINK}') AND regexp_matches({_PLAIN.format('x')}, '{P.PDF_TEXT}'))) > 0"


@query("tx_page_feat", f"""
    SELECT page_id, left({_ELEMENT.format('title')}, 200) AS title, left(nullif({_either(f'regexp_extract(html, {_q(P.META)})', P.CONTENT, 2)}, ''), 500) AS meta, left(nullif({_ELEMENT.format('h1')}, ''), 200) AS h1,
           left(nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, {_q(P.CRUMBS)}, 1), '(?s)<[^>]+>', '', 'g'), '\\s+', ' ', 'g')), ''), 200) AS breadcrumb,
           len(regexp_extract_all(body, '{P.TIME}')) AS times, {_PDF} AS has_schedule_pdf, {" + ".join(f"len(regexp_extract_all(lower(body), '{w}'))" for w in P.PAGE_WORDS)} AS keywords, len(regexp_extract_all(html, '(?is)<a\\s(?:[^>]*?\\s)?href\\s*=')) AS links
    FROM (SELECT page_id, html, {_VISIBLE} AS body FROM allpages)""")
def _(t):
    return P.page_features(all_pages(t))


@query("tx_html_md")
def _(t):
    return t.pages.select("page_id", F.md5(P.markdown(c("html"))).alias("md5"), F.length(P.markdown(c("html"))).alias("n"))


@query("tx_block", "SELECT page_id, CASE WHEN contains(lower(html), 'cloudflare') THEN 'cloudflare' WHEN contains(lower(html), 'captcha') THEN 'captcha' WHEN contains(lower(html), 'access denied') THEN 'waf' END AS block FROM pages")
def _(t):
    return t.pages.select("page_id", P.security_block(c("html")).alias("block"))


_URL_SCORE = f"least(CAST({' + '.join(f"CASE WHEN regexp_matches(lower(url), '{x}') THEN 0.2 ELSE 0 END" for x in P.URL_PATTERNS)} AS DOUBLE), 1.0)"
for _part, _step in P.PATH_STEPS:
    _URL_SCORE = f"(CASE WHEN regexp_matches(lower(url), '{_part}') THEN least(greatest({_URL_SCORE} + ({_step}), 0.0), 1.0) ELSE {_URL_SCORE} END)"
_URL_SCORE = f"round(CAST(CASE WHEN url IS NOT NULL THEN {_URL_SCORE} END AS DOUBLE), 4)"


@query("tx_url_pat", f"SELECT page_id, {_URL_SCORE} AS score FROM allpages")
def _(t):
    return all_pages(t).select("page_id", P.url_score(c("url")).alias("score"))


_PAGES = [(1, "https://a.org/bell-schedule", "Bell schedule", 12), (2, "https://a.org/news/1", "News", 2), (3, "https://b.org/about/hours", "Office hours", 5), (4, "https://c.org/x.pdf", "Times", 0), (5, None, None, None)]
share("crawled", f"SELECT * FROM (VALUES {_v(_PAGES)}) v(id, url, title, times)")
_HEUR = "least(greatest(CASE WHEN times > 10 THEN 50 WHEN times > 4 THEN 30 WHEN times > 0 THEN 15 ELSE 0 END + CASE WHEN regexp_matches(url, '(?i)bell|schedule') THEN 30 WHEN regexp_matches(url, '(?i)hours|about') THEN 15 ELSE 0 END + CASE WHEN regexp_matches(title, '(?i)bell|hours') THEN 20 ELSE 0 END + CASE WHEN url LIKE '%.pdf' THEN 10 ELSE 0 END - CASE WHEN regexp_matches(url, '(?i)news|blog') THEN 20 ELSE 0 END, 0), 100)"


def crawled(t):
    return t.values("id int, url string, title string, times int", *_PAGES)


@query("tx_url_heur", f"SELECT id, {_HEUR} AS score FROM crawled")
def _(t):
    n, u = c("times"), c("url")
    w = lambda cond, v: F.when(cond, v).otherwise(0)
    s = F.when(n > 10, 50).when(n > 4, 30).when(n > 0, 15).otherwise(0) + F.when(u.rlike("(?i)bell|schedule"), 30).when(u.rlike("(?i)hours|about"), 15).otherwise(0)
    s = s + w(c("title").rlike("(?i)bell|hours"), 20) + w(u.endswith(".pdf"), 10) - w(u.rlike("(?i)news|blog"), 20)
    return crawled(t).select("id", F.least(F.greatest(s, F.lit(0)), F.lit(100)).alias("score"))


def _points(text):
    n, lower = f"len(regexp_extract_all({text}, '{TIME}'))", f"lower({text})"
    return (
        f"(CASE WHEN {n} > 20 THEN 5 WHEN {n} > 5 THEN 3 ELSE 0 END + CASE WHEN contains({lower}, 'bell schedule') THEN 3 WHEN contains({lower}, 'school hours') THEN 2 ELSE 0 END"
        f" + CASE WHEN len(regexp_extract_all({lower}, 'period\\s*\\d|1st\\s*period|2nd\\s*period')) > 3 THEN 2 ELSE 0 END"
        f" + CASE WHEN regexp_matches({lower}, 'start time|end time|dismissal') THEN 1 ELSE 0 END)"
    )


share("alltexts", "SELECT doc_id, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT -doc_id, text FROM texts WHERE text IS NOT NULL")


@query("tx_pdf_triage", f"SELECT doc_id, CAST(least({_points('text')}, 10) AS INTEGER) AS points, {_points('text')} >= 7 AS is_schedule, array_to_string(regexp_extract_all(text, '{TIME}')[1:10], ',') AS first FROM alltexts")
def _(t):
    docs = t.documents.select(c("doc_id").cast("long").alias("doc_id"), "text").unionByName(texts(t).select((-c("doc_id")).cast("long").alias("doc_id"), "text")).where("text is not null")
    points, first = P.triage(c("text"))
    return docs.select("doc_id", points.alias("points"), (points >= 7).alias("is_schedule"), F.array_join(first, ",").alias("first"))


_PARTS = "list_filter(list_transform(regexp_split_to_array(lower(regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')), '[-_/.]'), lambda x: trim(x)), lambda x: x <> '')"


def _words_sql(known):
    return f"list_filter([{', '.join(f"'{k}'" for k in known)}], lambda k: len(list_filter({_PARTS}, lambda y: contains(y, k) OR contains(k, y))) > 0)"


@query("tx_kw", f"SELECT page_id, array_to_string({_words_sql(P.POSITIVE)}, ',') AS positive, array_to_string({_words_sql(P.NEGATIVE)}, ',') AS negative FROM allpages")
def _(t):
    words = lambda known: F.array_join(P.keywords(c("url"), known), ",")
    return all_pages(t).select("page_id", words(P.POSITIVE).alias("positive"), words(P.NEGATIVE).alias("negative"))


@query("tx_glob", f"SELECT page_id, CASE WHEN len(k) = 0 THEN NULL WHEN len(k) = 1 THEN '**/*' || k[1] || '*' ELSE '**/*' || k[1] || '*' || k[2] || '*' END AS glob FROM (SELECT page_id, {_words_sql(P.POSITIVE)} AS k FROM allpages)")
def _(t):
    return all_pages(t).select("page_id", P.glob(P.keywords(c("url"), P.POSITIVE)).alias("glob"))


@query("st_acquire", f"""
    SELECT page_id, site, rank_score, CAST(least(points, 10) AS INTEGER) AS points, CASE WHEN points >= 7 THEN 'active' WHEN points >= 3 THEN 'quarantine' ELSE 'rejected' END AS status
    FROM (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1) AS site, {_URL_SCORE} AS rank_score, coalesce({_points(_VISIBLE)}, 0) AS points FROM allpages)
    WHERE rank_score >= 0.3 QUALIFY row_number() OVER (PARTITION BY site ORDER BY rank_score DESC, page_id) <= 5""")
def _(t):
    return P.acquisition(all_pages(t))


SCHOOLS = [(1, "Oak Elementary School", 10), (2, "Elm Middle", 20), (3, "Ash Senior High", 30), (4, "Ivy Academy", 5), (5, "Fir Primary", 15), (6, "Yew Elementary", 25), (7, "Box High", 8), (8, None, 1)]
share("schools", f"SELECT id, name, pupils, coalesce({LEVEL.format('name')}, 'unknown') AS level FROM (VALUES {_v(SCHOOLS)}) v(id, name, pupils)")


def schools(t):
    return t.values("id int, name string, pupils int", *SCHOOLS).withColumn("level", P.level_of(c("name"), "unknown"))


@query("tx_school_level", "SELECT * FROM schools")
def _(t):
    return schools(t)


@query("tx_sample", "SELECT id, level FROM schools QUALIFY row_number() OVER (PARTITION BY level ORDER BY pupils DESC, id) <= 2")
def _(t):
    return top_per_group(schools(t), ["level"], [F.desc("pupils"), c("id")], 2).select("id", "level")


@query("tx_rep_sample", "SELECT id, level FROM schools WHERE level <> 'unknown' QUALIFY row_number() OVER (PARTITION BY level ORDER BY id) = 1")
def _(t):
    return latest_per_key(schools(t).where("level <> 'unknown'"), ["level"], [c("id")]).select("id", "level")


_PREFIX = ("www", "schools", "bells", "hs", "ms")


@query("tx_subdomains", "SELECT DISTINCT 'https://' || p || '.' || d || '.org' AS url FROM (SELECT lower(replace(name, '#', '')) AS d FROM districts) CROSS JOIN (VALUES " + ", ".join(f"('{p}')" for p in _PREFIX) + ") v(p)")
def _(t):
    # each name once, before there are five of it, and only where equal names are together: a task that combined what it
    # reads would hold all that.  No prefix has a dot, so other pairs give other addresses; without a name there is one null.
    d = districts(t).select(F.lower(F.replace("name", F.lit("#"), F.lit(""))).alias("d")).repartition("d").distinct()
    prefixes = F.when(c("d").isNull(), F.array(F.lit(_PREFIX[0]))).otherwise(F.array(*map(F.lit, _PREFIX)))
    return d.select(F.explode(prefixes).alias("p"), "d").select(F.concat(F.lit("https://"), "p", F.lit("."), "d", F.lit(".org")).alias("url"))


@query("tx_links", f"""
    SELECT page_id, pos, href, text, CASE WHEN contains(lower(text), 'elem') THEN 'elementary' WHEN regexp_matches(lower(text), 'middle|junior') THEN 'middle' WHEN regexp_matches(lower(text), 'high|senior') THEN 'high' END AS level
    FROM (SELECT page_id, pos, {_either('tag', P.HREF, 3)} AS href, {_PLAIN.format('tag')} AS text
          FROM (SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS pos, unnest(l) AS tag FROM (SELECT page_id, regexp_extract_all(html, {_q(P.ANCHOR)}) AS l FROM allpages WHERE html IS NOT NULL)))
    WHERE contains(lower(href), 'school') OR contains(lower(text), 'school')""")
def _(t):
    return P.links(all_pages(t))


scalar("tx_pdf_url", S, _s("https://a.org/x.pdf", "https://a.org/x.PDF?v=1", "https://drive.google.com/file/d/1", "https://a.org/pdf", None), lambda x: F.when(F.lower(x).rlike(r"\.pdf(\?|$)"), "pdf").when(x.contains("drive.google.com") | x.contains("docs.google.com"), "drive").otherwise("page"), "CASE WHEN regexp_matches(lower(x), '\\.pdf(\\?|$)') THEN 'pdf' WHEN contains(x, 'drive.google.com') OR contains(x, 'docs.google.com') THEN 'drive' ELSE 'page' END")


# ---- document handling
@query("d_extract", "SELECT doc_id, CASE WHEN length(trim(text)) > 0 THEN 'text' ELSE 'ocr' END AS method FROM documents")
def _(t):
    return t.documents.select("doc_id", F.when(F.length(F.trim("text")) > 0, "text").otherwise("ocr").alias("method"))


@query("d_pdf_file", "SELECT doc_id, count(*) AS n, count(DISTINCT level) AS levels FROM pdflines GROUP BY 1")
def _(t):
    return P.schedule_lines(texts(t)).groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("level").alias("levels"))


@query("d_html_strip", "SELECT page_id, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS md5 FROM pages")
def _(t):
    return t.pages.select("page_id", F.md5(F.regexp_replace("html", "<[^>]+>", " ")).alias("md5"))


# the texts as files of districts, with a hint of the level in some names
_FILE = "doc_id || CASE doc_id % 4 WHEN 0 THEN '_elem' WHEN 1 THEN '_HS' WHEN 2 THEN '_junior' ELSE '' END || '.txt'"
HINTS = (("elementary", "elem|primary|k-[56]"), ("middle", "middle|junior|ms|[67]-8"), ("high", "high|hs|secondary|9-12"))
_HINT = "CASE " + " ".join(f"WHEN regexp_matches(lower(file), '{p}') THEN '{n}'" for n, p in HINTS) + " END"
share("districtfiles", f"SELECT doc_id // 3 AS district, doc_id, {_FILE} AS file, text FROM texts WHERE text <> ''")
share("texts_d", "SELECT district AS doc_id, string_agg(chr(10) || chr(10) || '--- ' || file || ' ---' || chr(10) || chr(10) || text, '' ORDER BY doc_id) AS text FROM districtfiles GROUP BY 1")
for _name in ("textlines", "tablecells", "celltimes", "fromtables", "fromregex", "parsed"):
    share(f"{_name}_d", re.sub(r"\b(FROM|JOIN) (texts|textlines|tablecells|celltimes|fromtables|fromregex)\b", r"\1 \2_d", SHARED[_name]))


def combined_schedules(files):
    """(district, level, start, stop, minutes, source): what a district's files give together; else what each gives.

    files: (district, doc_id, file, text).  A file whose name speaks of a level is asked for that level only, and the
    first file that has a level gives it.
    """
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "file", "text"))), lambda r: F.concat(F.lit("\n\n--- "), r["file"], F.lit(" ---\n\n"), r["text"])), "")  # the files of one district
    whole = files.groupBy("district").agg(body.alias("text")).withColumnRenamed("district", "doc_id")
    together = parsed(whole).withColumnRenamed("doc_id", "district").withColumn("source", F.lit("all files"))
    hint = F.when(F.lit(False), F.lit(""))
    for level, pattern in HINTS:
        hint = hint.when(F.lower("file").rlike(pattern), level)
    rest = files.join(together.select("district").distinct(), "district", "left_anti")
    each = parsed(rest.select("doc_id", "text")).join(rest.select("doc_id", "district", c("file").alias("source"), hint.alias("hint")), "doc_id").where("hint is null or hint = level")
    first = latest_per_key(each, ["district", "level"], [c("doc_id")])
    return together.drop("method").unionByName(first.select("district", "level", "start", "stop", "minutes", "source"))


@query("d_combine", f"""
    SELECT doc_id AS district, level, start, stop, minutes, 'all files' AS source FROM parsed_d
    UNION ALL SELECT district, level, start, stop, minutes, file FROM (
        SELECT f.district, f.doc_id, p.level, p.start, p.stop, p.minutes, f.file FROM parsed p JOIN districtfiles f ON f.doc_id = p.doc_id
        WHERE f.district NOT IN (SELECT doc_id FROM parsed_d) AND coalesce({_HINT}, p.level) = p.level)
    QUALIFY row_number() OVER (PARTITION BY district, level ORDER BY doc_id) = 1""")
def _(t):
    k = c("doc_id")
    name = F.concat(k.cast("string"), F.when(k % 4 == 0, "_elem").when(k % 4 == 1, "_HS").when(k % 4 == 2, "_junior").otherwise(""), F.lit(".txt"))
    return combined_schedules(texts(t).where("text <> ''").select(F.floor(k / 3).cast("int").alias("district"), "doc_id", name.alias("file"), "text"))


@query("d_import_sched", "SELECT doc_id, level, start, stop, minutes FROM parsed WHERE NOT (doc_id = 1 AND level = 'high')")
def _(t):
    have = t.values("doc_id int, level string", (1, "high"))
    return parsed(texts(t)).join(have, ["doc_id", "level"], "left_anti").select("doc_id", "level", "start", "stop", "minutes")


@query("d_manual_sched", "SELECT doc_id, level, 'human_provided' AS method, 'high' AS confidence, '{\"start\":\"' || start || '\",\"stop\":\"' || stop || '\"}' AS raw FROM fromtables")
def _(t):
    return table_schedules(texts(t)).select("doc_id", "level", F.lit("human_provided").alias("method"), F.lit("high").alias("confidence"), F.to_json(F.struct("start", "stop")).alias("raw"))


scalar("d_folders", S, _s("CA/Oak Unified (CA)", "TX/Elm ISD", "plain", None), lambda x: F.concat_ws("|", F.regexp_extract(x, r"^([A-Z]{2})/", 1), F.trim(F.regexp_replace(F.regexp_replace(x, r"^[A-Z]{2}/", ""), r"\s*\([A-Z]{2}\)$", ""))), "CASE WHEN x IS NULL THEN '' ELSE regexp_extract(x, '^([A-Z]{2})/', 1) || '|' || trim(regexp_replace(regexp_replace(x, '^[A-Z]{2}/', ''), '\\s*\\([A-Z]{2}\\)$', '')) END")
scalar("d_level_file", S, _s("oak_high.pdf", "ms-times.pdf", "elem.html", "all.txt", None), lambda x: F.when(F.lower(x).contains("high"), "high").when(F.lower(x).rlike("middle|ms-"), "middle").when(F.lower(x).contains("elem"), "elementary").otherwise("district"), "CASE WHEN contains(lower(x), 'high') THEN 'high' WHEN regexp_matches(lower(x), 'middle|ms-') THEN 'middle' WHEN contains(lower(x), 'elem') THEN 'elementary' ELSE 'district' END")


@query("d_lookup", """
    WITH w AS (SELECT * FROM (VALUES ('customer#000000007'), ('Customer#00000001 District'), ('nobody')) v(name)), n AS (SELECT name, lower(trim(regexp_replace(name, '(?i)\\s+district$', ''))) AS key FROM w)
    SELECT n.name, d.district_id FROM n LEFT JOIN (SELECT n.key, min(district_id) AS district_id FROM n JOIN districts d ON lower(d.name) = n.key OR contains(lower(d.name), n.key) GROUP BY 1) d ON d.key = n.key""")
def _(t):
    w = t.values("name string", ("customer#000000007",), ("Customer#00000001 District",), ("nobody",))
    n = w.withColumn("key", F.lower(F.trim(F.regexp_replace("name", r"(?i)\s+district$", ""))))
    hits = districts(t).select("district_id", F.lower("name").alias("d")).join(F.broadcast(n), c("d").contains(c("key"))).groupBy("key").agg(F.min("district_id").alias("district_id"))  # a given list of names
    return n.join(hits, "key", "left").select("name", "district_id")


_DRIVE = r"(?:/file/d/|/document/d/|/spreadsheets/d/|/open\?id=|[?&]id=)([A-Za-z0-9_-]+)"
scalar("d_drive_id", S, _s("https://drive.google.com/file/d/ABC_1/view", "https://docs.google.com/document/d/x-Y/edit", "https://drive.google.com/uc?id=Q9", "https://a.org", None), lambda x: F.nullif(F.regexp_extract(x, _DRIVE, 1), F.lit("")), f"nullif(regexp_extract(x, '{_DRIVE}', 1), '')")
scalar("d_export_url", S, _s("https://docs.google.com/document/d/x-Y/edit", "https://docs.google.com/spreadsheets/d/S1/edit", "https://a.org", None), lambda x: F.when(x.contains("/document/d/"), F.format_string("https://docs.google.com/document/d/%s/export?format=pdf", F.regexp_extract(x, _DRIVE, 1))).when(x.contains("/spreadsheets/d/"), F.format_string("https://docs.google.com/spreadsheets/d/%s/export?format=csv", F.regexp_extract(x, _DRIVE, 1))), f"CASE WHEN contains(x, '/document/d/') THEN 'https://docs.google.com/document/d/' || regexp_extract(x, '{_DRIVE}', 1) || '/export?format=pdf' WHEN contains(x, '/spreadsheets/d/') THEN 'https://docs.google.com/spreadsheets/d/' || regexp_extract(x, '{_DRIVE}', 1) || '/export?format=csv' END")


@query("d_domain", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS domain FROM pages")
def _(t):
    return t.pages.select("page_id", T.host(c("url")).alias("domain"))


@query("d_level_eq", "SELECT id, name FROM schools WHERE level = 'elementary'")
def _(t):
    return schools(t).where("level = 'elementary'").select("id", "name")


def dictionary(t, *names):
    """(place, line) of a data dictionary in markdown: a section for each table with a row for each column."""
    lines = ["# Data dictionary"]
    for name in names:
        lines += ["", f"## {name}", "", "| Column | Type | Nullable |", "|---|---|---|"]
        lines += [f"| {f.name} | {f.dataType.simpleString()} | {'yes' if f.nullable else 'no'} |" for f in getattr(t, name).schema]
    return t.values("place int, line string", *enumerate(lines))


_DICT = ["# Data dictionary"] + [x for table, columns in (("region", (("r_regionkey", "int"), ("r_name", "string"))), ("nation", (("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")))) for x in ("", f"## {table}", "", "| Column | Type | Nullable |", "|---|---|---|", *(f"| {n} | {k} | yes |" for n, k in columns))]


@query("d_dict", f"SELECT * FROM (VALUES {_v(list(enumerate(_DICT)))}) v(place, line)")
def _(t):
    return dictionary(t, "region", "nation")


@query("d_campaign", "SELECT state, count(*) AS n, greatest(3 - count(*), 0) AS needed FROM districts WHERE enrollment > 9000 GROUP BY 1")
def _(t):
    return districts(t).where("enrollment > 9000").groupBy("state").agg(F.count("*").alias("n"), F.greatest(3 - F.count("*"), F.lit(0)).alias("needed"))


def files_of(spark, folder, pattern):
    """(file, modified, newest) of the files of a folder whose names match; the newest by time, then by name."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    found = found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), c("modificationTime").alias("modified"))
    last = found.agg(F.max(F.struct("modified", "file")).alias("last"))
    return found.crossJoin(F.broadcast(last)).select("file", "modified", (F.struct("modified", "file") == c("last")).alias("newest"))  # one row


@query("d_files")
def _(t):
    return files_of(t.spark, t.folder, "*.parquet").select("file", "newest")
