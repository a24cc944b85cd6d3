"""Relational building blocks: latest rows, absent keys, upserts, chunks, tops, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should leave no ties."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def target_or_latest(df: DataFrame, key: list[str], year: str, target: int, ties: list[Column]) -> DataFrame:
    """Rows of the target year if the table has any at all, else each key's latest row."""
    any_target = df.agg(F.coalesce(F.bool_or(F.col(year) == target), F.lit(False)).alias("__any"))
    chosen = df.crossJoin(F.broadcast(any_target)).where((F.col(year) == target) | ~F.col("__any")).drop("__any")  # one row
    return latest_per_key(chosen, key, [F.desc(year), *ties])


def absent(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    return df.join(other.select(*key).distinct(), key, "left_anti")


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], ties: list[Column] | None = None) -> DataFrame:
    """Incoming rows in place of current ones of the same key, null keys being equal; of several incoming the first by `ties`."""
    both = current.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    return latest_per_key(both, key, [F.desc("__new"), *(ties or [])]).drop("__new")


def insert_absent(current: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Current rows, and the incoming ones whose key is new."""
    return current.unionByName(absent(incoming, current, key))


def replace_where(current: DataFrame, incoming: DataFrame, column: str, value) -> DataFrame:
    """What a delete of one value of a column and an insert leave."""
    return current.where(~F.col(column).eqNullSafe(F.lit(value))).unionByName(incoming)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def chunked(df: DataFrame, group: list[str], order: list[Column], size: int) -> DataFrame:
    """Each group cut into runs of `size` rows, with `chunk` from 0 inside the group."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
    return df.withColumn("chunk", F.floor(place / size))


def pivot_sum(df: DataFrame, key: list[str], column: str, value: str, categories: list[str], fill: int | None = None) -> DataFrame:
    """One column for each listed category; a category that a key lacks is null, or `fill`."""
    wide = df.groupBy(*key).pivot(column, categories).agg(F.sum(value))
    return wide.na.fill(fill, categories) if fill is not None else wide


def unpivot_present(df: DataFrame, key: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row for each column that isn't null, from one scan."""
    return df.unpivot(key, columns, name, value).where(F.col(value).isNotNull())


def coverage(keys: DataFrame, known: DataFrame, key: str, show: int = 20) -> DataFrame:
    """(matched, unmatched, percent, first) of keys against the known ones; `first`: the least unmatched keys."""
    found = keys.select(key).distinct().join(known.select(key).distinct().withColumn("__in", F.lit(1)), key, "left")
    least = found.where("__in is null").orderBy(key).limit(show).agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("first"))
    sizes = found.agg(F.count("__in").alias("matched"), F.count_if(F.col("__in").isNull()).alias("unmatched"), F.round(F.count("__in") * 100.0 / F.count("*"), 4).alias("percent"))
    return sizes.crossJoin(least)  # one row each
