import math
import random

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import simhash
from lectern.llm.common import components


def text_of(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = text_of(rng, 1)
    return " ".join(words)


def brute_groups(texts, radius):
    codes = []
    for t in texts:
        words = np.array([], np.uint64)
        import pyarrow as pa

        for _, h, *_ in simhash.hashed_words(pa.array([t]), fold=True):
            words = h
        codes.append(simhash.code_of(words) if len(words) else None)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if codes[i] and codes[j] and sum((x ^ y).bit_count() for x, y in zip(codes[i], codes[j], strict=True)) <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(5)
    base = [text_of(rng, rng.choice([30, 80, 200])) for _ in range(60)]
    near = [edited(rng, t, max(1, len(t.split()) // 30)) for t in base[:30] for _ in range(2)]
    return base + near + base[:5], base


def test_groups_are_those_of_all_pairs(documents):
    texts, _ = corpus()
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_groups(documents(texts), tile=16).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts, simhash.RADIUS)


def test_near_copies_are_found_and_others_left(documents):
    texts, base = corpus()
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_groups(documents(texts)).collect()}
    assert all(got[i] == i for i in range(len(base)))
    found = [got[60 + 2 * i + k] == i for i in range(30) for k in range(2)]
    assert sum(found) >= 0.9 * len(found)
    assert all(got[120 + i] == i for i in range(5))


def test_short_texts_are_not_alike_by_chance():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4, 5, 6):
        codes = np.array([simhash.code_of(rng.integers(1, 1 << 63, n, dtype=np.uint64)) for _ in range(3000)], np.uint64)
        order = np.argsort(np.bitwise_count(codes).sum(axis=1), kind="stable")
        ones = np.bitwise_count(codes).sum(axis=1).mean() / 128
        assert 0.49 < ones < 0.51
        i, _ = simhash.close_pairs(codes[order], codes[order], simhash.RADIUS, True)
        assert not len(i)
    same = np.array([simhash.code_of(np.repeat(rng.integers(1, 1 << 63, 1, dtype=np.uint64), 2)) for _ in range(3000)], np.uint64)  # "ha ha"
    same = same[np.argsort(np.bitwise_count(same).sum(axis=1), kind="stable")]
    assert not len(simhash.close_pairs(same, same, simhash.RADIUS, True)[0])


def test_a_very_long_text(documents):
    rng = random.Random(2)
    long = text_of(rng, 60_000)
    got = {r["doc_id"]: r["group_id"] for r in simhash.near_groups(documents([long, edited(rng, long, 1500), text_of(rng, 50)])).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_close_pairs_against_all_pairs():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, (500, 2), dtype=np.uint64)
    a[250:] = a[:250] ^ np.uint64(0b1011)
    order = np.argsort(np.bitwise_count(a).sum(axis=1), kind="stable")
    a = a[order]
    d = np.bitwise_count(a[:, None] ^ a[None]).sum(axis=2, dtype=int)
    i, j = simhash.close_pairs(a, a, 30, True)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(p, q) for p, q in zip(*np.nonzero(d <= 30), strict=True) if p < q}
    i, j = simhash.close_pairs(a[:100], a[100:], 50, False)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*np.nonzero(d[:100, 100:] <= 50), strict=True))


def test_bands_hold_all_pairs_and_compare_few():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, (6000, 2), dtype=np.uint64)
    bits = rng.permuted(np.tile(np.arange(128) < np.arange(3000)[:, None] % 40, 1), axis=1)  # up to 39 bits are turned
    a[3000:] = a[:3000] ^ np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    for radius in (3, simhash.RADIUS, 33):
        want = set()
        for at in range(0, len(a), 500):
            d = np.bitwise_count(a[at : at + 500, None] ^ a[None]).sum(axis=2, dtype=np.int16)
            want |= {(p + at, q) for p, q in zip(*np.nonzero(d <= radius), strict=True) if p + at < q}
        i, j = simhash.close_pairs(a, a, radius, True)
        assert len(i) == len(want) and set(zip(i.tolist(), j.tolist(), strict=True)) == want
        i, j = simhash.close_pairs(a[:3000], a[3000:], radius, False)
        assert set(zip(i.tolist(), (j + 3000).tolist(), strict=True)) == {x for x in want if x[0] < 3000 <= x[1]}
    # of random codes in a large tile a small share is compared at all
    for codes, most in ((200_000, 0.1), (1_000_000, 0.07)):
        parted = simhash.bands(codes)
        assert sum(width for _, width, *_ in parted) == 128
        met = sum(math.comb(width, k) / 2**width for _, width, near, *_ in parted for k in range(near + 1))
        assert met < most


def test_very_many_codes_that_are_all_close():
    codes = np.zeros((5000, 2), np.uint64)
    codes[:, 0] = np.flatnonzero(np.bitwise_count(np.arange(1 << 14)) <= 6)[:5000]
    root, seen = np.arange(5000), 0
    for i, j in simhash.band_pairs(codes, codes, simhash.RADIUS, True, simhash.bands(5000)[-1]):
        assert len(i) <= simhash._HELD + simhash._LANE
        seen += len(i)
        root = simhash._linked(root, i, j)
    assert not root.any() and seen >= 5000 * 4999 // 2


def test_links_over_tiles_and_bands(spark):
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 1 << 63, (6000, 2), dtype=np.uint64)
    turned = rng.permuted(np.tile(np.arange(128) < simhash.RADIUS, (2000, 1)), axis=1)
    codes[4000:] = codes[:2000] ^ np.packbits(turned, axis=1, bitorder="little").view(np.uint64)
    table = spark.createDataFrame([tuple(r) for r in codes.view(np.int64).tolist()], "lo long, hi long")
    for tile in (5000, 10_000):  # more than _WHOLE: with bands
        root = {r["node"]: r["root"] for r in components(simhash.near_links(table, tile=tile)).collect()}
        signed = [tuple(r) for r in codes.view(np.int64).tolist()]
        assert {tuple(k): tuple(v) for k, v in root.items()} == {max(p, q): min(p, q) for p, q in zip(signed[:2000], signed[4000:], strict=True)}


def test_one_row_of_each_group_stays(documents):
    rng = random.Random(1)
    t = text_of(rng, 100)
    rows = [(4, t), (3, edited(rng, t, 1)), (3, "q w e"), (3, "q w e"), (8, None), (8, None), (9, ""), (10, " \n"), (None, t), (11, text_of(rng, 9))]
    df = documents(rows).withColumns({"lo": F.lit(1), "cid": F.lit("x"), "root": F.lit(None).cast("int")})
    got = simhash.drop_near_copies(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([3, 3, 8, 8, 9, 10, 11], key=str)
    groups = sorted(((r["doc_id"], r["group_id"], r["group_size"]) for r in simhash.near_groups(df).collect()), key=str)
    assert (4, 3, 3) in groups and (None, 3, 3) in groups and (8, 8, 1) in groups and (9, 9, 1) in groups


def test_empty_table(documents):
    assert simhash.near_groups(documents([])).count() == 0
    assert simhash.drop_near_copies(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_recall_at_the_edge():
    rng = np.random.default_rng(1)
    words = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64)
    edits = round(200 * (1 - simhash.FOUND_FROM) / (1 + simhash.FOUND_FROM) / 3)  # each takes three triples and brings three
    found = 0
    for _ in range(300):
        a = words(200)
        b = a.copy()
        b[((np.arange(edits) + 0.5) * 200 / edits).astype(int)] = words(edits)
        found += sum((x ^ y).bit_count() for x, y in zip(simhash.code_of(a), simhash.code_of(b), strict=True)) <= simhash.RADIUS
    assert found >= 0.9 * 300
