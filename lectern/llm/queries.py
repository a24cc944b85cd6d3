"""Queries over the whole synthetic tables, one for each operator of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, language_model, packing, simhash, substring_dedup, topk, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.score(pages, url_filter.learn(pages))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_model.score(docs, language_model.train(docs))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_url_filter": op3_url_filter,
        "op4_toxicity": op4_toxicity,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_warc": op6_warc,
        "op7_bpe": op7_bpe,
        "op8_simhash": op8_simhash,
        "op9_topk": op9_topk,
        "op10_packing": op10_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": """
            SELECT doc_id,
                   CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS keep_id,
                   CASE WHEN text IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY text) END AS copies
            FROM documents""",
        "op2_substring_dedup": substring_dedup.oracle_sql(),
        "op6_warc": """
            SELECT page_id, url, strlen(html) AS n_bytes, md5(html) AS md5 FROM pages""",
        "op9_topk": topk.oracle_sql(),
    }
