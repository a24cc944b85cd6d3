import random

from pyspark.sql import functions as F

from lectern.llm import exact_dedup


def groups(df, **more):
    return sorted(((r["doc_id"], r["keep_id"], r["copies"]) for r in exact_dedup.exact_groups(df, **more).collect()), key=str)


def brute(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if u == t] if t is not None else [i]
        ids = [j for j in same if j is not None]
        out.append((i, min(ids) if ids else None, len(same)))
    return sorted(out, key=str)


def test_against_brute_force_with_many_levels(documents):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 9, 16, 17, 60]))) for _ in range(300)]
    texts += texts[:40] + ["ab" * 30, "ab" * 30, "ab" * 29 + "aa"]
    rows = list(enumerate(texts))
    for size in (3,):
        assert groups(documents(rows), block_bytes=size) == brute(rows)


def test_nulls_empties_repeats(documents):
    rows = [(1, None), (2, None), (None, "x"), (3, "x"), (3, "x"), (4, ""), (5, ""), (3, "y"), (6, "é" * 9), (7, "é" * 9), (7, "é" * 9), (None, None)]
    assert groups(documents(rows), block_bytes=8) == brute(rows)


def test_kept_rows_and_extra_columns(documents):
    rows = [(5, "a b"), (2, "a b"), (9, None), (9, None), (7, "c"), (7, "c"), (None, "a b"), (8, "")]
    df = documents(rows).withColumns({"name": F.lit(1), "pos": F.lit("p"), "level": F.lit(0.5)})
    got = exact_dedup.drop_exact_copies(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["text"] is not None) == [(2, "a b"), (7, "c"), (8, "")]
    assert got.where("text is null").count() == 2


def test_of_repeated_rows_the_least_by_all_columns_stays(documents, spark):
    df = documents([(1, "same"), (1, "same"), (1, "same")]).withColumn("n_chars", F.lit(4)).withColumn("source", F.element_at(F.array(F.lit("z"), F.lit("b"), F.lit("k")), (F.spark_partition_id() % 3 + 1).cast("int")))
    df = df.union(df.withColumn("source", F.lit("a")))
    for some in (df, df.withColumn("m", F.create_map("lang", "source"))):
        got = exact_dedup.drop_exact_copies(some).collect()
        assert [(r["doc_id"], r["source"]) for r in got] == [(1, "a")]


def test_a_very_long_text_and_a_hot_group(documents):
    long = "word and " * 200_000
    rows = [(i, long if i % 9 == 0 else "hot" if i % 3 else f"t{i}") for i in range(40)] + [(50, long + "x")]
    assert groups(documents(rows).repartition(4)) == brute(rows)


def test_empty_table(documents):
    assert groups(documents([])) == []
    assert exact_dedup.drop_exact_copies(documents([])).count() == 0
