import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__

corpus_pipeline = pytest.importorskip("corpus_pipeline") if __spark_entry__._pipeline is not None else None
pytestmark = pytest.mark.skipif(corpus_pipeline is None, reason="the pipeline was taken out")


def word(rng):
    return "".join(rng.choice("bcdfghjklmnp") + rng.choice("aeiou") for _ in range(3))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(13)
    text = lambda n: " ".join(word(rng) for _ in range(n))
    clean = [text(rng.randrange(90, 160)) for _ in range(60)]
    passage = text(60)
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i]) for i in range(10)]  # exact copies
    for i in range(10, 20):  # near copies
        w = clean[i].split()
        w[5] = word(rng)
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{text(70)} {passage} {text(70)}") for i in range(4)]
    rows += [(400 + i, "You are an idiot and a moron, you worthless scum. I will kill you, you vermin. " + text(20)) for i in range(5)]
    rows += [(500, None), (501, ""), (502, "x"), (503, "x"), (None, text(80))]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, dict(rows), passage


def test_stages_take_effect(spark, folder):
    path, rows, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic, exact, near, cut = seen
    assert set(rows) - set(toxic) == {400 + i for i in range(5)}
    assert set(toxic) - set(exact) == {100 + i for i in range(10)} | {503}
    assert set(exact) - set(near) == {200 + i for i in range(10, 20)}
    assert set(cut) == set(near)
    assert sum(passage in (t or "") for t in cut.values()) == 1 and passage in cut[300]
    assert all(cut[i] == rows[i] for i in cut if i is None or not 300 < i < 304)
    packed = corpus_pipeline.run(spark, path)
    assert packed.columns == [*docs.columns, "n_tokens", "bucket", "bucket_tokens", "batch"]
    assert {r["doc_id"]: r["text"] for r in packed.collect()} == cut and packed.count() == len(cut)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "substring dedup", "packing"]


def test_empty_tables_and_clashing_columns(spark, folder, tmp_path):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    extra = {"root": F.lit("r"), "batch": F.lit("b"), "name": F.lit(1), "owner": F.lit(None).cast("int"), "toxic": F.lit(True), "row": F.array(F.lit(1)), "score": F.create_map(F.lit("k"), F.lit("v"))}
    long = docs.limit(1).select(F.lit(9999).cast("long").alias("doc_id"), F.repeat(F.lit("lang wort "), 150_000).alias("text"), "lang", "source", F.lit(1_500_000).cast("long").alias("n_chars"))
    for name, some in (("empty", docs.limit(0)), ("odd", docs.union(long).withColumns(extra))):
        some.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.limit(0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert set(some.columns) | {"n_tokens", "bucket", "bucket_tokens", "batch"} == set(got.columns)
        kept = {r["doc_id"]: r for r in got.collect()}
        if name == "empty":
            assert not kept
        else:
            assert 9999 in kept and set(range(60)) <= set(kept) and kept[9999]["root"] == "r" and kept[9999]["score"] == {"k": "v"}
