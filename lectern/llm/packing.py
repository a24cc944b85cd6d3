"""Packing: length buckets that minimise padding, and token-budget batches inside each bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import written

BUCKETS = 8
#: Tokens of a batch, padding included; a document longer than that is a batch of its own.
TOKEN_BUDGET = 16_384
ADDED = ("n_tokens", "bucket", "bucket_tokens", "batch")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The largest length of each bucket, so that padding every document to its bucket's largest length costs least.

    lengths: distinct, ascending.  The cost of a last bucket (i, j] is length[j] * documents - tokens, a line in
    length[j] for each i, so the best i is the top of a lower hull: each bucket takes one pass over the lengths.  Of
    equally good boundaries the smallest set of buckets and then the least lengths are taken.
    """
    n = len(lengths)
    if not n:
        return []
    docs = [0, *np.cumsum(counts, dtype=object).tolist()]
    cost = [lengths[j - 1] * docs[j] for j in range(1, n + 1)]  # padded tokens with one bucket
    came: list[list[int]] = [[0] * n]
    best, used = cost[-1], 1
    for k in range(2, min(buckets, n) + 1):
        hull: list[tuple[int, int, int]] = []  # (slope, intercept, i)
        now, frm, at = [None] * n, [0] * n, 0
        for j in range(k, n + 1):
            i = j - 1  # the last bucket may start after i; slopes fall as i grows
            line = (-docs[i], cost[i - 1], i)
            while len(hull) >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) < (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                hull.pop()
            hull.append(line)
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            now[j - 1] = x * docs[j] + hull[at][0] * x + hull[at][1]
            frm[j - 1] = hull[at][2]
        came.append(frm)
        cost = [v if v is not None else cost[q] for q, v in enumerate(now)]
        if cost[-1] < best:
            best, used = cost[-1], k
    out, j = [], n
    for k in range(used - 1, -1, -1):
        out.append(lengths[j - 1])
        j = came[k][j - 1]
    return out[::-1]


def _count(spark: SparkSession, path: str):
    """A column function: the number of byte-level BPE tokens of a text; only the texts go to Python."""
    sent = spark.sparkContext.broadcast(bpe.file_bytes(path))

    def run(texts: pa.Array) -> pa.Array:
        count = bpe.counter(path, sent.value)
        return pa.array([count(t) if (t := x.as_py()) else 0 for x in texts], pa.int64())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "bigint")


def _rank():
    """A column function: a row's place in its bucket among the rows of its task, which are sorted by bucket."""

    def run(buckets: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last, done = None, 0
        for column in buckets:
            bucket = np.asarray(column)
            if not len(bucket):
                yield pa.array([], pa.int64())
                continue
            first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            start = np.flatnonzero(first)[np.cumsum(first) - 1]
            rank = np.arange(len(bucket)) - start + np.where((start == 0) & (bucket == last), done, 0)
            last, done = bucket[-1], int(rank[-1]) + 1
            yield pa.array(rank, pa.int64())

    run.__annotations__ = {"buckets": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, keep: bool = False, path: str = bpe.DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_tokens, batch) of each row; with `keep` after the columns of docs, texts too.

    n_tokens counts the byte-level BPE tokens of the whole text.  Bucket boundaries come from the histogram of all rows'
    counts (one row for each distinct length reaches the driver).  In each bucket rows are taken in the order of doc_id,
    nulls last; `budget // bucket_tokens` of them, one at least, make a batch.  Batches are numbered from 0 in each
    bucket.  Null and empty texts have no tokens and go to the first bucket with the rest.  Repeated rows are packed
    each; rows with one id are in the order of their length, then of a hash of the text.  Without `keep` extra columns
    are ignored; with it they go along, except those that have the name of an added one.  An empty table gives an empty
    result.

    One range shuffle puts rows in order, with all they carry; ties are parted by a number for each row, so that an id
    of very many rows is no one task's.  Places in a task are raised by the rows of the tasks before it.
    """
    names = [c for c in docs.columns if c not in ADDED] if keep else ["doc_id"]
    carried = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    given = docs.select(_count(docs.sparkSession, path)("text").alias("n_tokens"), F.col("doc_id").cast("long").alias("i"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("u"), carried)
    sized = written(given, "lengths")
    histogram = sized.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    tops = boundaries([r[0] for r in histogram], [r[1] for r in histogram], buckets)
    edges = F.array(*[F.lit(t).cast("long") for t in tops]) if tops else F.array(F.lit(0).cast("long"))
    bucket = F.size(F.filter(edges, lambda t: t < F.col("n_tokens"))).cast("long").alias("bucket")
    order = ["bucket", F.col("i").asc_nulls_last(), "n_tokens", "h", "u"]
    placed = sized.select(bucket, "n_tokens", "i", "h", "u", "row").repartitionByRange(*order).sortWithinPartitions(*order)
    local = written(placed.select("bucket", "n_tokens", "row", F.spark_partition_id().alias("at"), _rank()("bucket").alias("rank")), "ranks")
    # a row for each task and bucket, of which a task of the sort has few: small enough for a broadcast
    sizes = local.groupBy("bucket", "at").agg(F.count("*").alias("n"))
    before = sizes.select("bucket", "at", (F.sum("n").over(Window.partitionBy("bucket").orderBy("at")) - F.col("n")).alias("before"))
    top = F.element_at(edges, (F.col("bucket") + 1).cast("int"))
    room = F.greatest(F.floor(F.lit(budget) / F.greatest(top, F.lit(1))), F.lit(1))
    batch = F.floor((F.col("rank") + F.col("before")) / room).cast("long").alias("batch")
    own = [F.col("row")[c].alias(c) for c in names] if keep else [F.col("row.doc_id").cast("long").alias("doc_id")]
    return local.join(F.broadcast(before), ["bucket", "at"]).select(*own, "n_tokens", "bucket", top.alias("bucket_tokens"), batch)
