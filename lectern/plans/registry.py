"""How queries are declared: a function over the tables beside the SQL that states the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Common table expressions that SQL texts may name.
SHARED: dict[str, str] = {}


class Tables:
    """The tables of one folder; a table's schema is looked up when it is first named, and each naming is a scan of its own."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.schemas = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if name in self.schemas:
            return self.spark.read.schema(self.schemas[name]).parquet(path)
        df = self.spark.read.parquet(path)
        self.schemas[name] = df.schema
        return df

    def values(self, schema: str, *rows: tuple) -> DataFrame:
        return self.spark.createDataFrame(list(rows), schema)


def share(name: str, sql: str) -> None:
    if name in SHARED:
        raise ValueError(f"two shared expressions are named {name}")
    SHARED[name] = sql


def complete(sql: str) -> str:
    """The SQL with the shared expressions that it names, in the order that they need each other."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)):
            if name in SHARED and name not in seen:
                seen.add(name)
                visit(SHARED[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    heads = ", ".join(f"{n} AS ({SHARED[n]})" for n in needed)
    text = sql.strip()
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", text):
        return f"WITH {m[1] or ''}{heads}, {text[m.end() :]}"
    return f"WITH {heads} {text}"


def query(name: str, sql: str | None = None):
    """Register a function from Tables to a DataFrame, with its SQL where there is one."""

    def add(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql  # completed when it is asked for, when all shared expressions are known
        return f

    return add


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    return str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"


def scalar(name: str, schema: str, rows: list[tuple], column: Callable[..., Column], sql: str) -> None:
    """Register a column function over literal rows: the arguments, named as in the schema, and `out`."""
    names = [x.split()[0] for x in schema.split(",")]
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    types = [kinds[x.split()[1]] for x in schema.split(",")]
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types, strict=True))
    text = f"SELECT {', '.join(names)}, {sql} AS out FROM (SELECT {casts} FROM (VALUES {values}) v({', '.join(names)}))"

    def run(t: Tables) -> DataFrame:
        return t.values(schema, *rows).withColumn("out", column(*[F.col(n) for n in names]))

    query(name, text)(run)
