"""What the operators of this subpackage share: written tables that cut lineage, row keys, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID, HASH = "__row_id", "__row_hash"
NO_ID = (1 << 63) - 1


#: Bytes of one Arrow batch on its way to Python and back, about.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, unless it does so itself: ten thousand long texts in one would take too much memory."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lectern-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: lineage ends there and no lost executor takes it along.

    Results read such tables when they are asked for, so like checkpoints they stay until the folder is cleared.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Remove a table that written() made; nothing may read it afterwards."""
    spark = df.sparkSession
    jvm = spark._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getName().startswith("lectern-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(text: str = "text", ident: str = "doc_id") -> list[Column]:
    """Columns that tell rows apart even where ids repeat: the id and a hash of the text.

    A null id becomes the largest number, so that keys can be compared by plain equality and nulls come last.  Ids are
    whole numbers, or texts of them: others are an error, and the largest 64-bit number counts as null.
    """
    return [F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)).alias(ID), F.xxhash64(F.col(text)).alias(HASH)]


def id_back(column: str | Column) -> Column:
    """The id that row_key() was given."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID))


def one_each(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """`columns` of one row for each value of the keys: the least by those columns that can be ordered, in their order."""
    kinds = dict(rows.dtypes)
    whole, orderly = F.struct(*(F.col(f"`{c}`") for c in columns)), [F.col(f"`{c}`") for c in columns if "map<" not in kinds[c] and "variant" not in kinds[c]]
    least = F.min(whole) if len(orderly) == len(columns) else F.min_by(whole, F.struct(*orderly))
    return rows.groupBy(*keys).agg(least.alias("__row")).select("__row.*")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of the undirected edges, the smallest node that it is linked to.

    Large-star and small-star steps alternate until a round changes nothing; each round is written and reread, so that
    lineage doesn't grow and a lost executor costs one round at most.  Nodes are comparable values of any type.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()
    now = written(pairs, "star")
    mark = None
    while True:
        # minima are combined before they are shuffled and joined back, so that a node of very many links is no one
        # task's list: adaptive joins split it
        both = now.union(now.select("lo", "hi").toDF("hi", "lo"))
        # large star: every larger neighbour of u is linked to the least of u and its neighbours
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # small star: u and its smaller neighbours are linked to the least of them
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(small, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(small.toDF("hi", "lo")).where("hi <> lo").distinct()
        after = written(small, "star")
        was = mark
        mark = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
        drop_written(now)
        now = after
        if mark == was:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
