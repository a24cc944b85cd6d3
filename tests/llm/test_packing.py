import itertools
import os
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.llm import bpe, packing, queries

TABLES = "/root/testdata/sf0.01"


def least_padding(lengths, counts, buckets):
    n = len(lengths)
    best = None
    for k in range(1, min(buckets, n) + 1):
        for cut in itertools.combinations(range(n - 1), k - 1):
            tops = [lengths[i] for i in (*cut, n - 1)]
            cost = sum(c * next(t for t in tops if t >= x) for x, c in zip(lengths, counts, strict=True))
            best = cost if best is None else min(best, cost)
    return best


def test_boundaries_are_optimal():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 9)
        lengths = sorted(rng.sample(range(60), n))
        counts = [rng.randrange(1, 9) for _ in range(n)]
        for buckets in (1, 2, 3, 5):
            tops = packing.boundaries(lengths, counts, buckets)
            assert len(tops) <= buckets and tops == sorted(tops) and tops[-1] == lengths[-1]
            assert sum(c * next(t for t in tops if t >= x) for x, c in zip(lengths, counts, strict=True)) == least_padding(lengths, counts, buckets)
    assert packing.boundaries([], [], 4) == []


def bucket_sql(buckets=packing.BUCKETS, budget=packing.TOKEN_BUDGET):
    """pack() over t (doc_id, n_tokens): the dynamic programme as one common table expression for each bucket."""
    steps = ["d1 AS MATERIALIZED (SELECT j, len * docs AS cost, [len] AS tops FROM h)"]
    for k in range(2, buckets + 1):
        steps.append(
            f"d{k} AS MATERIALIZED (SELECT b.j, min(a.cost + b.len * (b.docs - p.docs)) AS cost, list_append(arg_min(a.tops, a.cost + b.len * (b.docs - p.docs)), any_value(b.len)) AS tops "
            f"FROM h b JOIN d{k - 1} a ON a.j < b.j JOIN h p ON p.j = a.j GROUP BY b.j)"
        )
    last = " UNION ALL ".join(f"SELECT cost, tops, {k} AS k FROM d{k} WHERE j = (SELECT max(j) FROM h)" for k in range(1, buckets + 1))
    return f"""
        WITH g AS (SELECT n_tokens AS len, count(*) AS n FROM t GROUP BY 1),
        h AS MATERIALIZED (SELECT row_number() OVER (ORDER BY len) AS j, len, CAST(sum(n) OVER (ORDER BY len) AS BIGINT) AS docs FROM g),
        {", ".join(steps)},
        best AS MATERIALIZED (SELECT tops FROM ({last}) ORDER BY cost, k LIMIT 1),
        p AS (SELECT doc_id, n_tokens, CAST(len(list_filter(tops, lambda x: x < n_tokens)) AS BIGINT) AS bucket, CAST(tops[len(list_filter(tops, lambda x: x < n_tokens)) + 1] AS BIGINT) AS bucket_tokens FROM t, best)
        SELECT doc_id, n_tokens, bucket, bucket_tokens,
               CAST((row_number() OVER (PARTITION BY bucket ORDER BY doc_id NULLS LAST, n_tokens) - 1) // greatest({budget} // greatest(bucket_tokens, 1), 1) AS BIGINT) AS batch
        FROM p"""


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
def test_the_query_against_sql_over_its_counts(spark):
    got = queries.op10_packing(spark, TABLES).toArrow()
    t = got.select(["doc_id", "n_tokens"])  # noqa: F841
    assert sorted(zip(*got.to_pydict().values(), strict=True)) == sorted(duckdb.sql(bucket_sql()).fetchall())
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall()
    coder = bpe.coder(bpe.DEFAULT_VOCABULARY)
    assert dict(zip(*t.to_pydict().values(), strict=True)) == {i: len(x) for (i, _), x in zip(texts, coder.encode([t for _, t in texts]).to_pylist(), strict=True)}


def tokens(texts):
    return [len(x or []) for x in bpe.coder(bpe.DEFAULT_VOCABULARY).encode(texts).to_pylist()]


def test_batches_against_brute_force(documents):
    rng = random.Random(6)
    rows = [(rng.randrange(200), " ".join("w" * 1 for _ in range(rng.randrange(0, 40)))) for _ in range(150)] + [(None, "a b"), (3, None), (4, ""), (5, " \n"), (7, "x y z")] + [(77, "hot id")] * 90
    n = tokens([t for _, t in rows])
    h = sorted(Counter(n).items())
    tops = packing.boundaries([x for x, _ in h], [c for _, c in h], 4)
    placed = sorted(((sum(t < x for t in tops), i is None, i or 0, x, i) for (i, _), x in zip(rows, n, strict=True)))
    want, rank = [], Counter()
    for b, _, _, x, i in placed:
        want.append((i, x, b, tops[b], rank[b] // max(1, 64 // max(1, tops[b]))))
        rank[b] += 1
    for some in (documents(rows), documents(rows).repartition(5)):
        assert sorted(map(tuple, packing.pack(some, 4, 64).collect()), key=str) == sorted(want, key=str)
    kept = packing.pack(documents(rows), 4, 64, keep=True)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", *packing.ADDED]
    assert sorted(((r["doc_id"], r["n_tokens"], r["bucket"], r["bucket_tokens"], r["batch"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(rows, key=str)


def test_a_very_long_text(documents):
    got = {r["doc_id"]: r for r in packing.pack(documents(["word " * 300_000, "x" * 200_000, "a"])).collect()}
    assert got[0]["n_tokens"] == 300_001 and got[1]["n_tokens"] == 25_000 and got[2]["n_tokens"] == 1 and {r["batch"] for r in got.values()} == {0}


def test_empty_table_and_clashing_columns(documents):
    assert packing.pack(documents([])).count() == 0
    assert packing.pack(documents([]), keep=True).count() == 0
    df = documents(["a b", "c"]).withColumns({"bucket": F.lit("x"), "batch": F.lit(1), "n_tokens": F.lit(9), "row": F.lit("r"), "at": F.lit(0), "rank": F.lit(None).cast("int")})
    got = packing.pack(df)
    assert got.columns == ["doc_id", "n_tokens", "bucket", "bucket_tokens", "batch"]
    assert sorted(r["n_tokens"] for r in got.collect()) == [1, 2]
    kept = packing.pack(df, keep=True)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "at", "rank", *packing.ADDED]
    assert sorted((r["text"], r["row"], r["n_tokens"]) for r in kept.collect()) == [("a b", "r", 2), ("c", "r", 1)]
