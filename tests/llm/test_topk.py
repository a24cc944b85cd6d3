import numpy as np

from lectern.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label string, rank string, distance string"


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "l", "r", "d") for i, v in rows], SCHEMA)


def brute(rows, k, every=1):
    kept = [(i, (np.array(v) > 0)) for i, v in rows]
    out = []
    for a, (i, x) in enumerate(kept):
        if i % every:
            continue
        near = sorted((int((x != y).sum()), j, b) for b, (j, y) in enumerate(kept) if b != a and len(x) == len(y))[:k]
        out += [(i, r + 1, j, d) for r, (d, j, _) in enumerate(near)]
    return sorted(out)


def test_all_rows_against_brute_force(spark):
    rng = np.random.default_rng(11)
    for width, n in ((64, 260), (20, 90), (16, 40)):
        base = rng.normal(size=(12, width))
        rows = [(int(i), (base[rng.integers(12)] + rng.normal(size=width) * 0.8).round(3).tolist()) for i in rng.permutation(n)]
        for every in (1, 5):
            got = topk.nearest(make(spark, rows), 7, every, shard=40, queries=32)
            assert sorted(map(tuple, got.collect())) == brute(rows, 7, every)


def test_vectors_of_several_lengths_and_a_hot_id(spark):
    rng = np.random.default_rng(13)
    rows = [(7 if i % 3 == 0 else i, rng.normal(size=(64, 20, 3)[i % 3]).round(3).tolist()) for i in range(120)]
    got = topk.nearest(make(spark, rows).repartition(3), 4, 1, shard=16, queries=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)


def test_ties_repeats_and_few_rows(spark):
    rows = [(1, [1.0] * 16), (1, [1.0] * 16), (2, [1.0] * 16), (5, [-1.0] * 16)]
    got = sorted(map(tuple, topk.nearest(make(spark, rows), 10, 1).collect()))
    assert got == brute(rows, 10)


def test_nulls_and_empty(spark):
    rows = [(1, [1.0, None, -1.0]), (2, [1.0, -1.0, -1.0]), (3, None), (None, [1.0, 1.0, 1.0]), (4, [1.0]), (5, [])]
    got = topk.nearest(make(spark, rows), 3, 1)
    assert got.columns == ["vec_id", "rank", "neighbour_id", "distance"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 2, 0), (2, 1, 1, 0)]
    assert topk.nearest(make(spark, [])).count() == 0
    assert topk.nearest(make(spark, [(1, None)])).count() == 0


def test_search_stops_only_when_covered():
    rng = np.random.default_rng(12)
    codes = rng.integers(0, 1 << 16, (400, 4)).astype(np.uint16)
    d, f = topk.top_k(topk.Index(codes), codes, np.arange(400), 5)
    bits = np.bitwise_count(codes[:, None] ^ codes[None]).sum(axis=2).astype(int)
    np.fill_diagonal(bits, 999)
    want = np.sort(bits * 1000 + np.arange(400), axis=1)[:, :5]
    assert (d * 1000 + f == want).all()
