"""Exact dedup by deterministic block naming."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HASH, ID, id_back, one_each, row_key, written

BLOCK_BYTES = 16_384


def _named(df: DataFrame, key: list[str], keep: list[str]) -> DataFrame:
    """Rows of `keep` with `name`: the rank of their key among all distinct keys, dense and starting from 0.

    One range shuffle sorts the keys; each partition numbers its own distinct keys in order, and the numbers of the
    partitions before it (one row a partition) are added, so equal keys and only they get equal names.  Equal keys meet
    in one task: the callers thin them out before.
    """
    schema = ", ".join(f"{n} {t}" for n, t in df.select(*keep).dtypes)
    width = len(key)

    def number(batches):
        last, count = None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for i in range(width):
                column = batch.column(i)
                if batch.num_rows > 1:
                    new[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            first = tuple(batch.column(i)[0].as_py() for i in range(width))
            new[0] = first != last
            names = count + np.cumsum(new)
            last, count = tuple(batch.column(i)[batch.num_rows - 1].as_py() for i in range(width)), int(names[-1])
            columns = [batch.column(i) for i in range(width, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.int64())], names=[*keep, "__at", "__local"])

    ordered = df.repartitionByRange(key[0]).sortWithinPartitions(*key)
    ordered = ordered.select(*key, *keep, F.spark_partition_id().alias("__at"))
    local = written(ordered.mapInArrow(number, f"{schema}, __at int, __local bigint"), "names")
    sizes = local.groupBy("__at").agg((F.max("__local") + 1).alias("n"))
    # one row for each partition of the sort, whatever the number of rows: small enough for one window and a broadcast
    before = sizes.select("__at", (F.sum("n").over(Window.orderBy("__at")) - F.col("n")).alias("before"))
    return local.join(F.broadcast(before), "__at").select(*keep, (F.col("before") + F.col("__local")).alias("name"))


def _thinned(batches):
    """Rows with a number for each distinct block of a batch; only the first of equal blocks keeps its bytes."""
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        found = batch.column(5).dictionary_encode()
        code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        again = np.ones(len(code), bool)
        again[np.unique(code, return_index=True)[1]] = False
        own = (batch.column(6)[0].as_py() << 40) + count + code
        count += len(found.dictionary)
        bodies = pc.if_else(pa.array(again), pa.scalar(None, batch.column(5).type), batch.column(5))
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), bodies, pa.array(own)], names=[ID, HASH, "last", "pos", "mark", "block", "own"])


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row id, row hash, rows, level, name): two non-null texts are equal exactly when level and name are.

    Texts are cut into blocks of `block_bytes` bytes, all blocks are sorted into integer names, and the names of
    adjacent pairs are named again, level by level, until one name is left for each document.  A document's level is
    the number of pairings it took; a document of one block is done at level 0 and takes no further part.
    """
    block = docs.where("text is not null").select(*row_key(), F.col("text").cast("binary").alias("body"))
    last = F.greatest(F.ceil(F.octet_length("body") / block_bytes), F.lit(1)).cast("int") - 1
    block = block.select(ID, HASH, last.alias("last"), F.posexplode(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes)))).alias("pos", "block"))
    # blocks are sorted by a hash before their bytes: range bounds are then sampled from numbers, not from blocks
    block = block.select(ID, HASH, "last", "pos", F.xxhash64("block").alias("mark"), "block", F.spark_partition_id().cast("long").alias("part"))
    # a task sends each distinct block of a batch once, under a number of its own, whatever the number of copies
    block = written(block.mapInArrow(_thinned, f"{ID} bigint, {HASH} bigint, last int, pos int, mark bigint, block binary, own bigint"), "blocks")
    names = _named(block.where("block is not null"), ["mark", "block"], ["own"])
    now = block.select(ID, HASH, F.lit(1).cast("long").alias("rows"), "last", "pos", "own").join(names, "own").drop("own")
    done, level = [], 0
    while True:
        done.append(now.where("last = 0").select(ID, HASH, "rows", F.lit(level).alias("level"), "name"))
        rest = now.where("last > 0")
        if rest.isEmpty():
            break
        half = F.shiftright("pos", 1)
        pairs = rest.groupBy(ID, HASH, F.shiftright("last", 1).alias("last"), half.alias("pos")).agg(
            F.sum(F.when(F.col("pos") % 2 == 0, F.col("rows"))).alias("rows"),  # a row that repeats id and text adds to its twin
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        pairs = written(pairs, "pairs")
        distinct = pairs.select("left", "right").distinct()
        names = _named(distinct.select(F.col("left").alias("__l"), F.col("right").alias("__r"), "left", "right"), ["__l", "__r"], ["left", "right"])
        now = pairs.join(names, ["left", "right"]).drop("left", "right")  # a pair of many rows is split by adaptive joins
        level += 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, keep_id, copies) for each row: the least id with the same text, and how many rows have that text.

    Null texts are no copies of anything: keep_id is their own id and copies is 1.  Empty texts are equal to each
    other.  Null ids come last in the order.  Rows that repeat id and text count as copies and appear as often as in
    the input; extra columns are ignored.  An empty table gives an empty result.
    """
    names = identities(docs, block_bytes)
    groups = names.groupBy("level", "name").agg(F.min(ID).alias("keep_id"), F.sum("rows").alias("copies"))
    each = names.select(ID, "level", "name", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    full = each.join(groups, ["level", "name"]).select(id_back(ID).alias("doc_id"), id_back("keep_id").alias("keep_id"), "copies")
    null = docs.where("text is null").select(F.col("doc_id").cast("long"), F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("copies"))
    return full.unionByName(null)


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, without those whose text is that of a row with a lesser id (nulls last).

    Of rows that repeat id and text the least by all columns stays.  Null texts stay.  Extra columns go along; names starting with two underscores are reserved.
    """
    names = identities(docs, block_bytes)
    kept = names.groupBy("level", "name").agg(F.min(F.struct(ID, HASH)).alias("k")).select(f"k.{ID}", f"k.{HASH}")
    stay = docs.where("text is not null").select("*", *row_key()).join(kept, [ID, HASH], "left_semi")
    return one_each(stay, [ID, HASH], docs.columns).unionByName(docs.where("text is null"))


__all__ = ["drop_exact_copies", "exact_groups", "identities"]
