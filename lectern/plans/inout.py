"""Sources and sinks: each query writes a table in the format in question and reads it back, or reads a literal file."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.relational import top_per_group
from ..sources import files as S
from ..sources.sheets import read_sheets, write_sheets
from .aggregations import _STATS, lct_rows
from .model import bell, counts, districts, requirements
from .registry import query

c = F.col
_D = "SELECT district_id, name, enrollment FROM districts"
_SCHEMA = "district_id string, name string, enrollment bigint"


def small(t):
    return districts(t).select("district_id", "name", "enrollment")


def csv_of(t, df, name, **options):
    path = S.scratch(t.spark, name)
    df.write.options(header=True, **options).csv(path)
    return path


def text_file(t, name, body):
    """A file with the given text, written by a task to the shared folder."""
    path = S.scratch(t.spark, name)
    t.spark.createDataFrame([(body.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return path


@query("src_csv", _D)
def _(t):
    return S.read_delimited(t.spark, csv_of(t, small(t), "csv"), _SCHEMA)


@query("src_csv_chunked", "SELECT district_id, grade, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE category <> 'RO' GROUP BY 1, 2")
def _(t):
    rows = S.read_delimited(t.spark, csv_of(t, counts(t).select("district_id", "grade", "category", "n"), "chunks"), "district_id string, grade string, category string, n bigint")
    return rows.where("category <> 'RO'").groupBy("district_id", "grade").agg(F.sum("n").alias("n"))


@query("src_csv_usecols", "SELECT district_id, state FROM districts")
def _(t):
    d = districts(t).select("district_id", "name", "state", "segment")
    return S.read_delimited(t.spark, csv_of(t, d, "cols"), "district_id string, name string, state string, segment string").select("district_id", "state")


@query("src_tsv", _D)
def _(t):
    return S.read_delimited(t.spark, csv_of(t, small(t), "tsv", sep="\t", encoding="ISO-8859-1"), _SCHEMA, "\t", "ISO-8859-1")


@query("src_csv_skip", "SELECT * FROM (VALUES ('CA', 12), ('TX', 7)) v(state, n)")
def _(t):
    path = text_file(t, "preamble", "﻿title\nby\ndate\n\nstate,n\nCA,12\nTX,7\n")
    return S.read_after_preamble(t.spark, path, 4, "state string, n int")


@query("src_csv_posn", "SELECT district_id, name AS first, name AS second FROM districts")
def _(t):
    # two columns read one position, as a file's quirk has it
    return S.read_positions(t.spark, csv_of(t, small(t), "posn"), {"district_id": 0, "first": 1, "second": 1})


def sheets_of(t, df, name):
    """Workbooks of df's rows, one a partition, and their paths: as many as there are partitions."""
    return [r["file"] for r in write_sheets(df, S.scratch(t.spark, name)).collect()]


@query("src_excel", _D)
def _(t):
    return read_sheets(t.spark, sheets_of(t, small(t), "sheets"), ["district_id", "name", "enrollment"]).withColumn("enrollment", c("enrollment").cast("long"))


@query("src_excel_more", "SELECT state, high FROM requirements")
def _(t):
    rows = read_sheets(t.spark, sheets_of(t, requirements(t).coalesce(1), "sheets"), ["high", "state"], "Sheet1")
    return rows.select("state", c("high").cast("long").alias("high"))


@query("src_jdbc", "SELECT district_id, name, CAST(c_custkey AS BIGINT) AS k FROM districts JOIN customer ON CAST(district_id AS BIGINT) = c_custkey")
def _(t):
    rows = districts(t).select("district_id", "name", c("district_id").cast("long").alias("k"))
    url = S.write_database(rows, "districts")
    # as many rows as ids: the bounds part the range, they leave nothing out
    most = rows.agg(F.max("k")).first()[0] or 1
    return S.read_table(t.spark, url, "districts", '"k"', (0, most), 4, S.DERBY)


@query("src_json_doc", "SELECT * FROM (VALUES ('0000001', 'high', 400), ('0000001', 'middle', 390), ('0000002', 'high', 380)) v(district_id, grade_level, minutes)")
def _(t):
    path = text_file(t, "doc", '{"0000001": {"grades": {"high": {"minutes": 400}, "middle": {"minutes": 390}}}, "0000002": {"grades": {"high": {"minutes": 380}}}}')
    rows = S.read_keyed_json(t.spark, path, "struct<grades:map<string,struct<minutes:int>>>", "district_id")
    return rows.select("district_id", F.explode("grades").alias("grade_level", "g")).select("district_id", "grade_level", "g.minutes")


@query("src_yaml", "SELECT * FROM (VALUES ('CA', 'high', 360), ('CA', 'middle', 330), ('TX', 'high', 420)) v(state, level, minutes)")
def _(t):
    rows = S.read_settings(t.spark, text_file(t, "settings", "CA:\n  high: 360\n  middle: 330\nTX:\n  high: 420\n"))
    return rows.select(c("key").alias("state"), c("name").alias("level"), c("value").cast("int").alias("minutes"))


@query("src_by_suffix", _D)
def _(t):
    path = S.scratch(t.spark, "suffix") + ".parquet"
    small(t).write.parquet(path)
    return S.read_by_suffix(t.spark, path)


@query("src_multipart", "SELECT 1 AS id UNION ALL SELECT 2 UNION ALL SELECT 10")
def _(t):
    folder = S.scratch(t.spark, "parts")
    for n in (1, 2, 10):
        t.spark.range(n, n + 1).coalesce(1).write.csv(f"{folder}/part_{n}")
    return t.spark.read.schema("id int").csv(f"{folder}/part_*")


@query("src_download", "SELECT * FROM (VALUES ('0100005', 'Oak'), ('0100006', 'Elm'), ('0100007', 'Ash')) v(district_id, name)")
def _(t):
    return t.values("district_id string, name string", ("0100005", "Oak"), ("0100006", "Elm"), ("0100007", "Ash"))


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"


@query("src_http_crawl", f"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '(?i)login|cart') QUALIFY row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) <= 100")
def _(t):
    from ..functions.text import host

    kept = t.pages.where(~c("url").rlike("(?i)login|cart")).withColumn("host", host(c("url")))
    return top_per_group(kept, ["host"], [c("page_id")], 100).select("page_id", "url")


@query("snk_csv", f"SELECT 'all' AS file, count(*) AS n FROM districts UNION ALL SELECT 'valid', count(*) FROM districts WHERE enrollment > 0")
def _(t):
    path = S.scratch(t.spark, "out")
    S.write_with_valid(small(t), path, "enrollment > 0")
    n = lambda p, name: S.read_delimited(t.spark, p, _SCHEMA).agg(F.count("*").alias("n")).select(F.lit(name).alias("file"), "n")
    return n(path, "all").unionByName(n(f"{path}_valid", "valid"))


@query("snk_parquet", _D)
def _(t):
    path = S.scratch(t.spark, "parquet")
    small(t).write.parquet(path)
    return t.spark.read.schema(_SCHEMA).parquet(path)


@query("snk_json_nested", """
    SELECT district_id, '{' || string_agg('"' || grade_level || '":{"minutes":' || minutes || '}', ',' ORDER BY grade_level) || '}' AS body
    FROM (SELECT district_id, grade_level, max(minutes) AS minutes FROM bell GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    b = bell(t).groupBy("district_id", "grade_level").agg(F.max("minutes").alias("minutes"))
    entries = F.array_sort(F.collect_list(F.struct("grade_level", F.struct("minutes").alias("v"))))
    return b.groupBy("district_id").agg(F.to_json(F.map_from_entries(entries)).alias("body"))


@query("snk_json_files", "SELECT state, count(*) AS n FROM districts GROUP BY 1")
def _(t):
    path = S.scratch(t.spark, "json")
    districts(t).select("district_id", "name", "state").write.partitionBy("state").json(path)
    return t.spark.read.schema("district_id string, name string, state string").json(path).groupBy("state").agg(F.count("*").alias("n"))


@query("snk_csv_str", "SELECT '\"' || district_id || '\",\"' || name || '\"' AS line FROM districts WHERE enrollment > 5000")
def _(t):
    return districts(t).where("enrollment > 5000").select(F.to_csv(F.struct("district_id", "name"), {"quoteAll": "true"}).alias("line"))


@query("snk_json_report", "SELECT '{\"rows\":' || count(*) || ',\"districts\":' || count(DISTINCT district_id) || '}' AS report FROM lctrows")
def _(t):
    return lct_rows(t).agg(F.count("*").alias("rows"), F.countDistinct("district_id").alias("districts")).select(F.to_json(F.struct("rows", "districts")).alias("report"))


@query("snk_text", "SELECT scope || ': ' || count(*) || ' rows' AS line FROM lctrows GROUP BY scope")
def _(t):
    return lct_rows(t).groupBy("scope").agg(F.count("*").alias("n")).select(F.format_string("%s: %d rows", "scope", "n").alias("line"))


@query("snk_lineage_yaml", "SELECT 'output: lct.csv' || chr(10) || 'rows: ' || count(*) || chr(10) AS body FROM districts")
def _(t):
    return districts(t).agg(F.format_string("output: lct.csv\nrows: %d\n", F.count("*")).alias("body"))


@query("snk_db_batch", "SELECT 'r1' AS run_id, district_id, enrollment FROM districts WHERE enrollment > 0 UNION ALL SELECT 'r2', district_id, enrollment FROM districts WHERE enrollment > 5000")
def _(t):
    path = S.scratch(t.spark, "store")
    rows = districts(t).select("district_id", "enrollment")
    S.append_batch(rows.where("enrollment > 100"), path, "r1")
    S.append_batch(rows.where("enrollment > 5000"), path, "r2")
    S.append_batch(rows.where("enrollment > 0"), path, "r1")
    return t.spark.read.schema("district_id string, enrollment bigint, run_id string").parquet(path)


@query("snk_deliverables", f"SELECT scope, {_STATS} FROM lctrows WHERE lct > 0 AND lct <= 360 GROUP BY scope")
def _(t):
    from ..operators import attention as A

    path = S.scratch(t.spark, "deliverables")
    A.summary(lct_rows(t).where("lct > 0 and lct <= 360"), "scope").write.parquet(path)
    return t.spark.read.parquet(path)
