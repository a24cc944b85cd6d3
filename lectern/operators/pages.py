"""Text, HTML and URL operators over crawled pages and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME = r"\d{1,2}:\d{2}\s*(?:AM|PM|am|pm|a\.m\.|p\.m\.)?"
LEVELS = (("elementary", r"(?i)\b(?:elementary|primary|k-5|k-6)\b"), ("middle", r"(?i)\b(?:middle|junior|6-8|7-8)\b"), ("high", r"(?i)\b(?:high|senior|9-12)\b"))
#: Pairs of words, joined by nothing, a dash, an underscore or a blank, and single words that a schedule's address has.
SCHEDULE_WORDS = (("bell", "schedule"), ("daily", "schedule"), ("school", "day"), ("school", "hours"), ("start", "time"), ("schedule", "information"), ("hours", "of", "operation"), ("arrival",), ("calendar",), ("dismissal",))
URL_PATTERNS = tuple(r"[-_\s]?".join(words) for words in SCHEDULE_WORDS)
#: What is added for each pattern; then, in this order and each clamped, bonuses and penalties of parts of the path.
PER_PATTERN, PATH_STEPS = 0.2, (("/(parents|families)", 0.1), ("/(about|information)", 0.05), ("/(news|blog)", -0.2), ("/(sports|athletics)", -0.3))
POSITIVE = tuple(sorted("bell schedule hours time start end dismissal daily regular modified early late period block schedules times periods blocks".split()))
NEGATIVE = tuple(sorted("assessment announcement athletic breakfast bus cafeteria calendar career employment event exam game job lunch menu news nutrition routes sports staff test transportation athletics buses events exams games jobs testing".split()))
PAGE_WORDS = ("bell", "dismissal", "end", "hours", "period", "schedule", "start", "times")
#: One cell's time range, and the levels that words of its row stand for; other rows are of high schools.
CELL_RANGE = r"(?i)(\d{1,2}:\d{2}\s*(?:AM|a\.m\.)?)\s*[-–—to]+\s*(\d{1,2}:\d{2}\s*(?:PM|p\.m\.)?)"
ROW_LEVELS = (("elementary", r"(?i)elementary|primary|k-?[56]|grades?\s*k"), ("middle", r"(?i)middle|junior\s*high|[67]-?8|grades?\s*6"))


def strip_tags(html: Column) -> Column:
    """Text of a page: scripts and styles out, tags to spaces, white space collapsed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?s)<[^>]+>", " "), r"\s+", " "))


def element(html: Column, name: str) -> Column:
    """The text of the first element of a name; '' without one."""
    return F.trim(F.regexp_replace(F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}>", 1), r"(?s)<[^>]+>", " "))


def level_of(text: Column, default: str | None = "high") -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in LEVELS:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise(F.lit(default))


def url_score(url: Column) -> Column:
    """What the patterns of schedules that match give, up to 1; then bonuses and penalties, each clamped to [0, 1]."""
    u = F.lower(url)
    score = F.least(sum((F.when(u.rlike(p), PER_PATTERN).otherwise(0.0) for p in URL_PATTERNS), F.lit(0.0)), F.lit(1.0))
    for part, step in PATH_STEPS:
        score = F.when(u.rlike(part), F.least(F.greatest(score + F.lit(step), F.lit(0.0)), F.lit(1.0))).otherwise(score)
    return F.when(url.isNotNull(), F.round(score, 4))


#: An anchor and its address, in quotes of either kind or none.
ANCHOR = r"(?is)<a\s[^>]*>.*?</a>"
HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
META = r"""(?is)<meta\b[^>]*\bname\s*=\s*["']description["'][^>]*>"""
CONTENT = r"""(?is)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')"""
CRUMBS = r"""(?is)<[a-z][a-z0-9]*\b[^>]*(?:class|aria-label)\s*=\s*["'][^"']*breadcrumb[^"']*["'][^>]*>(.*?)</(?:nav|ol|ul|div|p|span|section)>"""
PDF_LINK, PDF_TEXT = r"(?i)\.pdf$|\.pdf\?", r"(?i)schedule|bell|times|hours"


def _either(text: Column, pattern: str, groups: int) -> Column:
    """The first group that has something."""
    return F.concat(*[F.regexp_extract(text, pattern, i + 1) for i in range(groups)])


def anchor(tag: Column) -> tuple[Column, Column]:
    """Address and text of an anchor."""
    return _either(tag, HREF, 3), F.trim(F.regexp_replace(tag, r"(?s)<[^>]+>", ""))


def visible(html: Column) -> Column:
    """The text of a page's body, or of all of it where no body begins."""
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)", 1)
    return strip_tags(F.when(body != "", body).otherwise(html))


def page_features(pages: DataFrame) -> DataFrame:
    """Title, meta description, first heading and breadcrumb, shortened; times, keywords, links and whether a PDF link's text speaks of schedules."""
    html = F.col("html")
    none = lambda x: F.nullif(x, F.lit(""))
    text = visible(html)
    crumbs = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(html, CRUMBS, 1), r"(?s)<[^>]+>", ""), r"\s+", " "))
    tags = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))
    pdf = F.exists(tags, lambda x: anchor(x)[0].rlike(PDF_LINK) & anchor(x)[1].rlike(PDF_TEXT))
    lower = F.lower(text)
    return pages.select(
        "page_id", F.left(element(html, "title"), F.lit(200)).alias("title"), F.left(none(_either(F.regexp_extract(html, META, 0), CONTENT, 2)), F.lit(500)).alias("meta"),
        F.left(none(element(html, "h1")), F.lit(200)).alias("h1"), F.left(none(crumbs), F.lit(200)).alias("breadcrumb"), F.regexp_count(text, F.lit(TIME)).alias("times"), pdf.alias("has_schedule_pdf"),
        sum((F.regexp_count(lower, F.lit(w)) for w in PAGE_WORDS[1:]), F.regexp_count(lower, F.lit(PAGE_WORDS[0]))).alias("keywords"), F.regexp_count(html, F.lit(r"(?is)<a\s(?:[^>]*?\s)?href\s*=")).alias("links"),
    )


def triage(text: Column) -> tuple[Column, Column]:
    """Tenths of a point that a document is a schedule, and its first ten times."""
    lower, n = F.lower(text), F.regexp_count(text, F.lit(TIME))
    points = F.when(n > 20, 5).when(n > 5, 3).otherwise(0) + F.when(lower.contains("bell schedule"), 3).when(lower.contains("school hours"), 2).otherwise(0)
    points = points + F.when(F.regexp_count(lower, F.lit(r"period\s*\d|1st\s*period|2nd\s*period")) > 3, 2).otherwise(0)
    points = points + F.when(lower.contains("start time") | lower.contains("end time") | lower.contains("dismissal"), 1).otherwise(0)
    return F.least(points, F.lit(10)), F.slice(F.regexp_extract_all(text, F.lit(TIME), F.lit(0)), 1, 10)


def triaged(points: Column) -> Column:
    return F.when(points >= 7, "active").when(points >= 3, "quarantine").otherwise("rejected")


def acquisition(pages: DataFrame, top: int = 5) -> DataFrame:
    """(page_id, site, rank_score, points, status): the best ranked pages of each site, captured and triaged.

    Pages are ranked by their addresses; of a site the `top` best that reach 0.3 are looked into, the lesser id first
    where scores are equal.
    """
    ranked = pages.select("page_id", F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#]*)", 1).alias("site"), url_score(F.col("url")).alias("rank_score"), "html").where("rank_score >= 0.3")
    place = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("rank_score"), "page_id"))
    best = ranked.withColumn("place", place).where(F.col("place") <= top)
    points = triage(visible(F.col("html")))[0]
    return best.select("page_id", "site", "rank_score", points.alias("points"), triaged(points).alias("status"))


def lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def schedule_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, level, start, end): of each line with two times or more the first and the last, once for each value."""
    found = lines(docs).withColumn("times", F.regexp_extract_all("line", F.lit(f"({TIME})"), F.lit(1))).where(F.size("times") >= 2)
    rows = found.select("doc_id", "pos", level_of(F.col("line"), None).alias("level"), F.trim(F.element_at("times", 1)).alias("start"), F.trim(F.element_at("times", -1)).alias("end"))
    return rows.groupBy("doc_id", "level", "start", "end").agg(F.min("pos").alias("pos"))


def table_cells(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, at, line, cell) of the filled cells of tables: runs of three lines or more with a bar, without the first two."""
    l = lines(docs).withColumn("in_table", F.col("line").contains("|"))  # noqa: E741
    t = l.withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy("doc_id", "in_table").orderBy("pos"))).where("in_table")
    own = Window.partitionBy("doc_id", "island")
    t = t.withColumns({"place": F.row_number().over(own.orderBy("pos")), "size": F.count("*").over(own)}).where("size >= 3 and place > 2")
    t = t.select("doc_id", "pos", "line", F.posexplode(F.split("line", r"\|")).alias("at", "cell"))
    return t.withColumn("cell", F.trim("cell")).where("cell <> ''")


def row_level(line: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in ROW_LEVELS:
        out = out.when(line.rlike(pattern), name)
    return out.otherwise("high")


def path_parts(url: Column) -> Column:
    """Parts of a URL's path, in lower case."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.filter(F.transform(F.split(F.lower(F.regexp_replace(path, ";[^/]*$", "")), "[-_/.]"), F.trim), lambda x: x != "")


def keywords(url: Column, known: tuple[str, ...]) -> Column:
    """The known words that hold a part of the URL's path or are held by one, sorted."""
    parts = path_parts(F.coalesce(url, F.lit("")))
    return F.filter(F.array(*map(F.lit, known)), lambda k: F.exists(parts, lambda x: x.contains(k) | k.contains(x)))


def glob(words: Column) -> Column:
    """A pattern for the first two words; null without any."""
    return F.when(F.size(words) == 0, F.lit(None).cast("string")).when(F.size(words) == 1, F.format_string("**/*%s*", words[0])).otherwise(F.format_string("**/*%s*%s*", F.get(words, F.lit(0)), F.get(words, F.lit(1))))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href, text, level) of each anchor with "school" in its address or text, in order."""
    tags = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))).alias("pos", "tag"))
    href, text = anchor(F.col("tag"))
    rows = tags.select("page_id", "pos", href.alias("href"), text.alias("text")).where(F.lower("href").contains("school") | F.lower("text").contains("school"))
    t = F.lower("text")
    level = F.when(t.contains("elem"), "elementary").when(t.contains("middle") | t.contains("junior"), "middle").when(t.contains("high") | t.contains("senior"), "high")
    return rows.withColumn("level", level)


def security_block(html: Column) -> Column:
    t = F.lower(html)
    return F.when(t.contains("cloudflare"), "cloudflare").when(t.contains("captcha"), "captcha").when(t.contains("access denied"), "waf")


def rankings(replies: DataFrame, known: DataFrame) -> DataFrame:
    """(url, score, reason) of a JSON reply, known URLs only, scores clamped to [0, 1]."""
    rows = F.from_json(F.regexp_extract("body", r"(?s)(\[.*\])", 1), "array<struct<url:string,score:double,reason:string>>")
    out = replies.select(F.explode(rows).alias("r")).select("r.url", F.least(F.greatest(F.col("r.score"), F.lit(0.0)), F.lit(1.0)).alias("score"), "r.reason")
    return out.join(known.select("url").distinct(), "url", "left_semi")


def markdown(html: Column) -> Column:
    """A page's markup as markdown: headings, items and links, other tags out, blank lines collapsed."""
    t = F.regexp_replace(html, r"(?is)<(script|style|nav)\b.*?</\1>", "")
    t = F.regexp_replace(t, r"(?is)<h1[^>]*>(.*?)</h1>", "\n# $1\n")
    t = F.regexp_replace(t, r"(?is)<h2[^>]*>(.*?)</h2>", "\n## $1\n")
    t = F.regexp_replace(t, r"(?is)<li[^>]*>(.*?)</li>", "\n- $1")
    t = F.regexp_replace(t, r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)</p>|<br\s*/?>", "\n"), r"(?s)<[^>]+>", "")
    return F.trim(F.regexp_replace(t, r"\n\s*\n+", "\n\n"))
