"""A document corpus made ready for training: toxic documents, copies, near copies and repeated passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and reread as the next
stage's docs.  All but the last return the columns of documents; the last adds the tokens, bucket and batch of each
document to them, texts included, in the order of buckets.  Extra columns go along.  An empty table passes through all
stages; what each does with nulls, empty and very long texts and repeated rows stands in its function's docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import exact_dedup, packing, simhash, substring_dedup, toxicity
from lectern.llm.common import written

#: The rows depend on a model trained from labels, on hash codes and on automata; SQL can't state them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, grammar)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, keep=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
