import random
import re

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import substring_dedup
from lectern.llm.automaton import SuffixAutomaton


def brute(rows, n):
    """Windows of n words by value: those of an earlier document go."""
    first: dict[tuple, tuple] = {}
    split = [(k, t, re.findall(r"[^\t\n\f\r ]+", t or "")) for k, t in rows]
    for k, _, w in split:
        for i in range(len(w) - n + 1):
            win = tuple(w[i : i + n])
            first[win] = min(first.get(win, k), k)
    out = []
    for k, t, w in split:
        gone = {p for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] < k for p in range(i, i + n)}
        if not gone:
            out.append(t)
            continue
        pieces = re.findall(r"[^\t\n\f\r ]+[\t\n\f\r ]*", t)
        out.append(re.match(r"[\t\n\f\r ]*", t)[0] + "".join(p for i, p in enumerate(pieces) if i not in gone))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdef") + rng.choice("xyz")
    passages = [" ".join(word() for _ in range(rng.randrange(8, 40))) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 30))) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randrange(1, 6))]
        texts.append(rng.choice(["", " ", "\n"]) + rng.choice([" ", "\n\n"]).join(parts))
    return texts + texts[:10] + ["", " ", "aa " * 90, "aa " * 70, "é à " * 30, "x é à " + "é à " * 25]


def test_against_all_windows(documents):
    texts = corpus(1)
    for n, anchor, shard, owner in ((10, 3, 50, 10**6), (12, 12, 10_000, 0), (10, 2, 500, 300)):
        got = {r["doc_id"]: r["text"] for r in substring_dedup.cut_repeats(documents(texts), n, anchor, shard, owner).collect()}
        assert [got[i] for i in range(len(texts))] == brute(list(enumerate(texts)), n)


def test_passages_of_fifty_words(documents):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    long, short = " ".join(word() for _ in range(60)), " ".join(word() for _ in range(49))
    own = [" ".join(word() for _ in range(30)) for _ in range(6)]
    texts = [f"{own[0]} {long} {own[1]}", f"{own[2]} {long} {own[3]}", f"{own[4]} {short}", f"{short} {own[5]}"]
    got = {r["doc_id"]: r for r in substring_dedup.cut_repeats(documents(texts)).collect()}
    assert got[0]["text"] == texts[0]
    assert got[1]["text"] == f"{own[2]} {own[3]}" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == texts[2] and got[3]["text"] == texts[3]


def test_one_passage_in_every_document_and_a_very_long_text(documents):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(55))
    own = [" ".join(word() for _ in range(rng.choice([3, 30]))) for _ in range(200)]
    own[150] = " ".join(word() for _ in range(120_000))
    texts = [f"{t} {passage} {t[::-1]}" for t in own]
    for owner_words in (substring_dedup.OWNER_WORDS, 1000):
        got = {r["doc_id"]: r["text"] for r in substring_dedup.cut_repeats(documents(texts), owner_words=owner_words).collect()}
        assert got[0] == texts[0] and all(got[i] == f"{t} {t[::-1]}" for i, t in enumerate(own) if i)


def test_nulls_ids_and_columns(documents):
    t = " ".join(f"w{i}" for i in range(20))
    rows = [(7, t), (None, t), (3, t), (3, t), (1, None), (2, ""), (5, t + " end")]
    df = documents(rows).withColumns({"s": F.lit(1), "owner": F.lit("o"), "spans": F.array(F.lit(1))})
    got = substring_dedup.cut_repeats(df, 10, 3)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([(7, ""), (None, ""), (3, t), (3, t), (1, None), (2, ""), (5, "end")], key=str)
    assert substring_dedup.cut_repeats(documents([]), 10, 3).count() == 0


def test_automaton_statistics():
    rng = random.Random(4)
    for _ in range(30):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(4)]
        sam = SuffixAutomaton()
        for t in texts[:3]:
            sam.add(t)
        q = texts[3]
        runs = {tuple(t[i:j]) for t in texts[:3] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        assert sam.statistics(q) == [max([0, *(n for n in range(1, i + 2) if tuple(q[i + 1 - n : i + 1]) in runs)]) for i in range(len(q))]


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 99, 70)
    for w in range(1, 30):
        assert (substring_dedup._sliding_min(x, w) == [x[i : i + w].min() for i in range(71 - w)]).all()
