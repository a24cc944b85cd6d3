import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lectern.llm import url_filter as U

SCHEMA = "page_id bigint, url string, html string, score string"


def urls(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.4
        host = f"{'-'.join(rng.choice(['win', 'free', 'x1', 'get']) for _ in range(3))}{rng.randrange(1000)}.{rng.choice(['xyz', 'top', 'com'])}" if bad else f"{rng.choice(['news', 'library', 'school'])}.{rng.choice(['org', 'com', 'edu'])}"
        path = "/".join(rng.choice(["a", "read", "item"]) for _ in range(rng.randrange(1, 5)))
        out.append((f"http{'' if bad and rng.random() < 0.7 else 's'}://{host}/{path}" + (f"?id={rng.randrange(10**9)}&r={rng.randrange(10**9)}" if bad else ""), int(bad)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, u, None, "s") for i, (u, _) in enumerate(rows)], SCHEMA)


def test_held_out_accuracy(spark):
    train, held = urls(800, 1), urls(400, 2)
    labels = spark.createDataFrame(train, "url string, bad int")
    first, again = ([(r["score"], r["blocked"]) for r in U.score(frame(spark, held), U.learn(labels, labels)).orderBy("page_id").collect()] for _ in range(2))
    assert first == again
    assert np.mean([blocked == bool(b) for (_, blocked), (_, b) in zip(first, held, strict=True)]) > 0.95


def by_hand(url):
    """The lexical features in plain Python."""
    m = re.match(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://(?:[^/?#@]*@)?([^/?#:]*)(?::[^/?#]*)?)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", url)
    scheme, host, path, query, fragment = (x or "" for x in m.groups())

    def entropy(text):
        n = Counter(text.encode())
        return -sum(k / n.total() * math.log2(k / n.total()) for k in n.values())

    digits = lambda text: sum(c.isdecimal() for c in text)
    return [
        len(url), len([x for x in path.split("/") if x]), digits(url) / max(1, len(url)), entropy(url), len([x for x in re.split("[&;]", query) if x]), len(query), len(host),
        len([x for x in host.split(".") if x]), host.count("-"), digits(host), entropy(host), scheme.lower() == "https", fragment != "", bool(re.search(r"\.[A-Za-z0-9_]{1,5}$", path)),
    ]


ODD = ["https://a-b.c1.org/x/y.html?p=1&q=22#t", "", "plain", "http://[bad", "HTTPS://User:pw@Host.EXAMPLE.com:8080//a//b.php?&&x;y#", "http://[::1]:80/x", "é://ü.de/ß?٣=1", "mailto:x@y.z", "a\nb#c\nd", "http://x." * 50, "//no.scheme/p.q", "?only=query", "#f"]


def test_features_against_plain_python():
    some = ODD + [u for u, _ in urls(200, 5)]
    got = U.lexical(pa.array(some))
    for url, row in zip(some, got, strict=True):
        assert np.allclose(row, by_hand(url)), url
    assert np.allclose(U.lexical(pa.array([None, "x"], pa.string()))[0], by_hand(""))


def test_suffixes(spark):
    given = {"https://a-b.c1.org/x": "org", "http://[bad": "[bad", "http://u@a.Example.COM:80/?q": "com", "https://x.de.": "de", "https://localhost": "localhost", "no url": "", "": "", "http:///p": "", "https://a.io#f": "io"}
    df = spark.createDataFrame([(k,) for k in given], "url string")
    assert {r[0]: r[1] for r in df.select("url", U.suffix(F.col("url"))).collect()} == given


def test_trees_against_every_split():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 6, 90), rng.normal(size=90).round(1), rng.integers(0, 2, 90)]).astype(float)
    bad = ((x[:, 0] > 2) ^ (x[:, 2] > 0)).astype(float)
    model = U.train(x, bad, 3)
    total = np.full(90, math.log(bad.mean() / (1 - bad.mean())))
    binned = model.binned(x)
    for t in range(3):
        p = 1 / (1 + np.exp(-total))
        g, h = p - bad, p * (1 - p)
        worth = lambda rows, g=g, h=h: g[rows].sum() ** 2 / (h[rows].sum() + U.L2)
        own = {0: np.arange(90)}
        for node in range(2**U.DEPTH - 1):
            rows = own[node]
            gains = {(f, c): worth(rows[binned[rows, f] <= c]) + worth(rows[binned[rows, f] > c]) - worth(rows) for f in range(3) for c in range(U.BINS)}
            f, c = int(model.feature[t, node]), int(model.cut[t, node])
            best = max(gains.values())
            assert best < 1e-9 or abs((gains[f, c] if c < U.BINS else 0.0) - best) < 1e-9
            own[2 * node + 1], own[2 * node + 2] = rows[binned[rows, f] <= c], rows[binned[rows, f] > c]
        for leaf in range(2**U.DEPTH):
            rows = own[2**U.DEPTH - 1 + leaf]
            value = -U.RATE * g[rows].sum() / (h[rows].sum() + U.L2)
            assert abs(model.leaf[t, leaf] - value) < 1e-9
            total[rows] += value
    assert np.allclose(model.probability(x), 1 / (1 + np.exp(-total)))


def test_suffix_statistics_are_of_all_labels_and_out_of_fold(spark):
    rows = [(f"https://h{i}.com/", 0) for i in range(300)] + [(f"https://h{i}.rare/", 1) for i in range(3)] + [("https://h0.rare/", 0)]
    labels = spark.createDataFrame(rows, "url string, bad int")
    model = U.learn(labels, labels, 50)
    got = {r["suffix"]: r for r in model.suffixes.collect()}
    assert abs(got["rare"]["suffix_share"] - 3 / 303) < 1e-12 and abs(got["rare"]["suffix_rate"] - (3 + 20 * 3 / 303) / 23) < 1e-12
    assert abs(model.rate - 3 / 303) < 1e-12


def test_edges(spark):
    rows = [(1, None, None, "s"), (2, "", "", "s"), (None, "https://casino.example/x", None, "s"), (3, "http://[bad", "", "s"), (3, "http://[bad", "", "s"), (4, "https://a.org/" + "x" * 100_000, "", "s")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = U.score(df, U.learn(df))
    assert got.columns == ["page_id", "url", "score", "blocked"] and got.count() == 6
    null = [r for r in got.collect() if r["url"] is None][0]
    assert null["score"] is None and null["blocked"] is False
    empty = spark.createDataFrame([], SCHEMA)
    assert U.score(empty, U.learn(empty)).count() == 0


def test_given_labels(spark):
    rows = urls(300, 3)
    df = spark.createDataFrame([(i, u, None, "s") for i, (u, _) in enumerate(rows)], SCHEMA)
    labels = spark.createDataFrame(rows, "url string, bad int")
    got = {r["page_id"]: r["blocked"] for r in U.score(df, U.learn(df, labels)).collect()}
    assert np.mean([got[i] == bool(b) for i, (_, b) in enumerate(rows)]) > 0.97
