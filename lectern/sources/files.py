"""Readers and writers for delimited, JSON, YAML-like and Parquet files."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share; a temporary one only where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="lectern-files-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, computed once and read back from a table beside the checkpoints."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_delimited(spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """Delimited text with a pinned schema: identifiers stay strings, and no pass is spent on inference."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("encoding", encoding).csv(path)


def read_after_preamble(spark: SparkSession, path: str, skip: int, schema: str) -> DataFrame:
    """Delimited text whose header stands after `skip` lines, each file read whole by one task."""
    lines = spark.read.text(path, wholetext=True).select(F.split(F.regexp_replace("value", "^﻿", ""), "\r?\n").alias("l"))
    rows = lines.select(F.explode(F.slice("l", skip + 2, F.greatest(F.size("l") - skip - 1, F.lit(0)))).alias("line")).where("trim(line) <> ''")
    return rows.select(F.from_csv("line", schema).alias("r")).select("r.*")


def read_positions(spark: SparkSession, path: str, places: dict[str, int]) -> DataFrame:
    """Columns by their place in the file, whatever the header calls them; the header line is left out."""
    raw = spark.read.option("header", False).csv(path)
    kept = [F.col(f"_c{i}").alias(n) for n, i in places.items()]
    first = next(iter(places.values()))
    return raw.where(F.col(f"_c{first}").rlike("^[0-9]")).select(*kept)


def read_keyed_json(spark: SparkSession, path: str, value: str, key: str = "key") -> DataFrame:
    """One row for each key of a JSON object whose values have the struct type `value`."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", f"map<string,{value}>")
    return text.select(F.explode(F.map_entries(pairs)).alias("e")).select(F.col("e.key").alias(key), "e.value.*")


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """(key, name, value) of a two-level settings file: `key:` lines with indented `name: value` lines under them."""
    text = spark.read.text(path, wholetext=True)
    blocks = text.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?m)^(\S[^:\n]*:[ \t]*\n(?:[ \t]+\S.*\n?)+)"), F.lit(1))).alias("b"))
    pairs = F.regexp_extract_all("b", F.lit(r"(?m)^[ \t]+(\S[^\n]*)$"), F.lit(1))
    rows = blocks.select(F.regexp_extract("b", r"^(\S[^:\n]*):", 1).alias("key"), F.explode(pairs).alias("p"))
    return rows.select("key", F.trim(F.split("p", ":", 2)[0]).alias("name"), F.trim(F.split("p", ":", 2)[1]).alias("value"))


def parts(folder: str, base: str) -> list[str]:
    """Paths of base_1, base_2, ... in a folder, in the order of their numbers."""
    import re

    local = folder.removeprefix("file://")
    found = [(int(m[1]), f) for f in os.listdir(local) if (m := re.fullmatch(rf"{re.escape(base)}_(\d+)\.\w+", f))]
    return [f"{folder}/{f}" for _, f in sorted(found)]


_FORMATS = {".csv": "csv", ".tsv": "csv", ".txt": "text", ".json": "json", ".parquet": "parquet", ".orc": "orc"}


def read_by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """A reader chosen by the suffix of the path; spreadsheets need the names of their columns: sheets.read_sheets()."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix not in _FORMATS:
        raise ValueError(f"no reader for {suffix or 'a path without a suffix'}")
    reader = spark.read.option("header", True) if suffix in (".csv", ".tsv") else spark.read
    return (reader.option("sep", "\t") if suffix == ".tsv" else reader).format(_FORMATS[suffix]).load(path)


def read_table(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, driver: str | None = None) -> DataFrame:
    """A table over JDBC, in ranges of a numeric column where one is given, so that no single task reads it all."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    r = r.option("driver", driver) if driver else r
    if column and bounds:
        r = r.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return r.load()


DERBY = "org.apache.derby.jdbc.EmbeddedDriver"
_KINDS = {"string": "CLOB", "bigint": "BIGINT", "int": "INTEGER"}


def write_database(df: DataFrame, table: str) -> str:
    """The URL of a new embedded database with the rows of df, to be read only, by any number of processes at once.

    Tasks write the rows as delimited text, the database that runs in the driver's JVM imports it file by file, and its
    closed files are put uncompressed into one archive; so no process holds the rows.  All of it is in the shared
    folder, which must be one of files.  Columns are text or whole numbers; nulls, empty and long texts, quotes and line
    breaks come back as they were.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "database")
    if not path.startswith(("file:/", "/")):
        raise ValueError(f"an embedded database needs a folder of files, not {path}")
    local = "/" + path.removeprefix("file:").lstrip("/")
    text = lambda n: F.concat(F.lit('"'), F.replace(F.col(f"`{n}`"), F.lit('"'), F.lit('""')), F.lit('"'))
    cells = [F.coalesce(text(n) if kind == "string" else F.col(f"`{n}`").cast("string"), F.lit("")) for n, kind in df.dtypes]
    df.select(F.concat_ws(",", *cells)).write.text(f"file://{local}-rows")
    connect = spark._jvm.java.sql.DriverManager.getConnection
    con = connect(f"jdbc:derby:{local};create=true")
    try:
        run = con.createStatement().execute
        run(f"CREATE TABLE {table} ({', '.join(f'"{n}" {_KINDS[kind]}' for n, kind in df.dtypes)})")
        for file in sorted(f for f in os.listdir(f"{local}-rows") if f.startswith("part-")):
            if os.path.getsize(f"{local}-rows/{file}"):
                run(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table.upper()}', '{local}-rows/{file}', ',', '\"', 'UTF-8', 0)")
    finally:
        con.close()
        try:
            connect(f"jdbc:derby:{local};shutdown=true")
        except Py4JJavaError as e:  # a database that was closed says so by this error
            if e.java_exception.getSQLState() != "08006":
                raise
    with zipfile.ZipFile(f"{local}.jar", "w", zipfile.ZIP_STORED) as z:
        for folder, _, files in os.walk(local):
            for f in files:
                z.write(os.path.join(folder, f), os.path.join("db", os.path.relpath(folder, local), f))
    for made in (local, f"{local}-rows"):
        shutil.rmtree(made)
    return f"jdbc:derby:jar:({local}.jar)db"


def write_with_valid(df: DataFrame, path: str, valid: str) -> None:
    """All rows as CSV under path, and those that satisfy `valid` beside them."""
    df.write.option("header", True).csv(path)
    df.where(valid).write.option("header", True).csv(f"{path}_valid")


def append_batch(df: DataFrame, path: str, run_id: str) -> None:
    """A run's rows as one partition of a Parquet table; writing it again replaces it alone."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
