import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from lectern.sources import files as S
from lectern.sources import sheets as X


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_bytes(text.encode() if isinstance(text, str) else text)
    return f"file://{p}"


def test_preamble_and_byte_order_mark(spark, tmp_path):
    path = put(tmp_path, "a.csv", "﻿x\ny\nstate,n\r\nCA,1\r\n\r\nTX,\n")
    assert sorted(map(tuple, S.read_after_preamble(spark, path, 2, "state string, n int").collect())) == [("CA", 1), ("TX", None)]
    assert S.read_after_preamble(spark, put(tmp_path, "b.csv", ""), 4, "a int").count() == 0


def test_ids_stay_text(spark, tmp_path):
    path = put(tmp_path, "i.tsv", "id\tn\n0012\t5\n".encode("latin-1"))
    assert S.read_delimited(spark, path, "id string, n int", "\t", "ISO-8859-1").first()["id"] == "0012"


def test_settings_and_keyed_json(spark, tmp_path):
    path = put(tmp_path, "s.yaml", "CA:\n  high: 360\n  note: a: b\nTX:\n  high: 420\n")
    assert sorted(map(tuple, S.read_settings(spark, path).collect())) == [("CA", "high", "360"), ("CA", "note", "a: b"), ("TX", "high", "420")]
    path = put(tmp_path, "d.json", '{"1": {"m": 4}, "2": {"m": null}}')
    assert sorted(map(tuple, S.read_keyed_json(spark, path, "struct<m:int>").collect())) == [("1", 4), ("2", None)]


def test_suffixes_and_parts(spark, tmp_path):
    with pytest.raises(ValueError):
        S.read_by_suffix(spark, "/x/y.xlsx")
    for n in (10, 2, 1):
        put(tmp_path, f"base_{n}.csv", f"id\n{n}\n")
    found = S.parts(f"file://{tmp_path}", "base")
    assert [f.rsplit("_", 1)[1] for f in found] == ["1.csv", "2.csv", "10.csv"]
    assert S.read_by_suffix(spark, found[2]).first()["id"] == "10"


def test_a_run_replaces_itself_alone(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    S.append_batch(spark.range(3), path, "a")
    S.append_batch(spark.range(5), path, "b")
    S.append_batch(spark.range(1), path, "a")
    n = spark.read.parquet(path).groupBy("run_id").agg(F.count("*").alias("n")).collect()
    assert {r["run_id"]: r["n"] for r in n} == {"a": 1, "b": 5}


BOOK = {
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Notes" sheetId="1" r:id="rId1"/><sheet name="Staff" sheetId="2" r:id="rId2"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId2" Target="/xl/worksheets/b.xml"/><Relationship Id="rId1" Target="worksheets/a.xml"/></Relationships>',
    "xl/sharedStrings.xml": '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>District</t></si><si><r><t>Tea</t></r><r><t>chers</t></r></si><si><t>Oak &amp; Elm</t></si></sst>',
    "xl/worksheets/a.xml": '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData/></worksheet>',
    "xl/worksheets/b.xml": '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="A3" t="s"><v>2</v></c><c r="B3"/><c r="C3"><f>1+1</f><v>2.5</v></c></row><row r="4"/><row r="5"><c r="C5"><v>7</v></c></row></sheetData></worksheet>',
}


def test_a_sheet_of_a_workbook(spark, tmp_path):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in BOOK.items():
            z.writestr(name, body)
    path = put(tmp_path, "b.xlsx", out.getvalue())
    got = X.read_sheets(spark, path, ["Teachers", "District", "Absent"], "Staff", 1)
    assert [tuple(r) for r in got.collect()] == [("2.5", "Oak & Elm", None), ("7", None, None)]
    assert X.read_sheets(spark, path, ["a"]).count() == 0 and X._column("AB12") == 27


def test_sheets_come_back_as_written(spark, tmp_path):
    df = spark.createDataFrame([("007", 'a <b> & "c"', 3), (None, " spaced ", None), ("8", "é\n漢", -5)], "id string, name string, n bigint")
    files = X.write_sheets(df.repartition(2), f"file://{tmp_path}/out").collect()
    assert sum(r["rows"] for r in files) == 3
    back = X.read_sheets(spark, [r["file"] for r in files], ["id", "name", "n"]).collect()
    assert sorted(map(tuple, back), key=str) == sorted([("007", 'a <b> & "c"', "3"), (None, " spaced ", None), ("8", "é\n漢", "-5")], key=str)


def test_the_newest_file(spark, tmp_path):
    import os

    from lectern.plans.texts import files_of

    for n, at in (("a.csv", 30), ("b.csv", 50), ("c.txt", 90), ("d.csv", 50)):
        put(tmp_path, n, "x")
        os.utime(tmp_path / n, (at, at))
    got = files_of(spark, f"file://{tmp_path}", "*.csv").collect()
    assert {r["file"]: r["newest"] for r in got} == {"a.csv": False, "b.csv": False, "d.csv": True}


def test_a_database_comes_back_as_written(spark, monkeypatch):
    rows = [("1", None, 1), ("2", "", 2), ("3", " a ", -3), ("4", 'a"b,c', 4), ("5", "a\nb\r\nc", 5), ("6", "é漢\\x", None), (None, "z", 7), ("8", "y" * 40_000, 8)]
    df = spark.createDataFrame(rows, "id string, name string, n bigint")
    for found in (df, df.limit(0)):
        url = S.write_database(found, "odd")
        back = S.read_table(spark, url, "odd", '"n"', (0, 8), 3, S.DERBY)
        assert back.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, found.collect()), key=str)
    monkeypatch.setattr(S, "scratch", lambda spark, name: f"hdfs://there/{name}")
    with pytest.raises(ValueError):
        S.write_database(df, "odd")


ON_A_CLUSTER = """
import sys
from pyspark.sql import SparkSession
from lectern.plans import catalog

conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "600m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": f"file://{sys.argv[1]}", "spark.sql.shuffle.partitions": "4"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
rows = catalog.queries()["src_jdbc"](spark, sys.argv[2]).collect()
print("found", len(rows), sum(int(r["district_id"]) == r["k"] and r["name"].endswith(r["district_id"]) for r in rows))
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_a_database_is_read_by_several_executors(spark, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", ON_A_CLUSTER, f"{tmp_path}/shared", "/root/testdata/sf0.001"], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    n = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    assert f"found {n} {n}" in done.stdout, done.stderr[-2000:]
