import random

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import language_model as L
from lectern.llm.tokens import hash_of


def corpus(n, seed):
    """Sentences of a chain in which a word decides the next one three times out of four."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(20)]
    out = []
    for _ in range(n):
        at, text = rng.randrange(20), []
        for _ in range(60):
            text.append(words[at])
            at = (at * 7 + 3) % 20 if rng.random() < 0.75 else rng.randrange(20)
        out.append(" ".join(text))
    return out


def test_held_out_text_is_scored_better_than_by_word_shares(documents):
    train, held = corpus(400, 1), corpus(40, 2)
    model = L.train(documents(train), 64, 16, 4, 64)
    rows = L.score(documents(held), model).collect()
    mean = sum(r["log_probability"] for r in rows) / sum(r["n_words"] for r in rows)
    shares = np.log(1 / 20)
    assert mean > shares + 0.4
    shuffled = [" ".join(random.Random(3).sample(t.split(), 60)) for t in held]
    assert sum(r["log_probability"] for r in L.score(documents(shuffled), model).collect()) < sum(r["log_probability"] for r in rows)


def test_probabilities_are_normalised_and_batched_as_one_by_one(documents):
    model = L.train(documents(corpus(30, 4)), 32, 8, 1)
    v = model.size
    scorer = L.Scorer(model)
    for a, b in ((0, 1), (v, v), (3, v)):
        one, two = np.full(v, a, np.int32), np.full(v, b, np.int32)
        word = np.arange(v)
        s = np.einsum("ij,ij->i", scorer.first[one] + scorer.second[two], scorer.word[word]) + scorer.bias[word] - scorer.normalisers(one, two)
        assert abs(np.exp(s).sum() - 1) < 1e-4
    text = "w1 w2 w3 unknown w4"
    n = model.numbers(np.array([hash_of(w) for w in text.split()], np.uint64))
    by_hand = scorer.log_probabilities(n, np.array([0, 5])).sum()
    got = L.score(documents([text, "w5", text]), model).orderBy("doc_id").collect()
    assert abs(got[0]["log_probability"] - by_hand) < 1e-3 and got[0]["log_probability"] == got[2]["log_probability"] and got[0]["n_unknown"] == 1


def test_edges(documents):
    model = L.train(documents([]), 16, 4, 1)
    assert L.score(documents([]), model).count() == 0
    df = documents([(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a " * 100_000), (4, "a b")]).withColumns({"n_words": F.lit("x"), "perplexity": F.lit(1)})
    got = {(r["doc_id"], r["n_words"]): r for r in L.score(df, L.train(df, 16, 4, 1)).collect()}
    assert got[1, None]["log_probability"] is None and got[2, 0]["log_probability"] == 0 and got[3, 0]["perplexity"] is None
    assert got[4, 100_000]["perplexity"] > 0 and (None, 2) in got and (4, 2) in got
    assert L.word_counts(df).agg(F.sum("n")).first()[0] == 100_004


def test_words_without_a_vector_are_told_apart(documents):
    often, rare = "table " * 40, " ".join(f"station{i}" for i in range(300))
    train = [*corpus(20, 5), often, "chair " * 6, rare]
    model = L.train(documents(train), 8, 4, 1)
    assert abs(np.exp(model.tail_share).sum() + np.exp(model.rare) - 1) < 1e-4
    codes = np.arange(257) + (ord("s") * 257 + ord("t")) * 257
    assert abs(model.spelling.probabilities(codes).sum() - 1) < 1e-6
    texts = ["table", "chair", "station777", "xqzvkjw777"]
    rows = L.score(documents(texts), model).orderBy("doc_id").collect()
    got = [r["log_probability"] for r in rows]
    assert got[0] > got[1] + 1 and got[1] > got[2] and got[2] > got[3] + 5
    assert [r["n_unknown"] for r in rows] == [0, 0, 1, 1]


def test_a_list_that_is_joined_scores_as_one_that_is_sent(documents):
    texts = [*corpus(20, 6), "table " * 40, "chair " * 6, " ".join(f"station{i}" for i in range(300)), None, "", " ", "xqz table chair", "xqz table chair"]
    sent, joined = (L.train(documents(texts), 8, 4, 1, listed_words=n) for n in (100, 0))
    assert sent.listed is None and len(joined.tail) == 0 and joined.listed.count() == len(sent.tail) > 2
    odd = documents([(i, t) for i, t in enumerate(texts)] + [(None, "chair never"), (3, "x " * 50_000)])
    a, b = (L.score(odd, m).orderBy("doc_id", "n_words").collect() for m in (sent, joined))
    for x, y in zip(a, b, strict=True):
        assert x[:3] == y[:3] and (x[3] is None) == (y[3] is None) and (x[4] is None) == (y[4] is None)
        assert x[3] is None or abs(x[3] - y[3]) <= 2e-4 + 1e-6 * abs(x[3])


def test_normalisers_of_far_apart_scores():
    model = L.start([5, 9, 11], [4, 3, 2], 12, 2)
    context, place, word, bias = model.parts(model.parameters)
    context[:], word[:] = np.array([[60, 0], [0, 60], [1, 1], [-60, 60], [0, 0]]), np.array([[3, -3], [-3, 3], [0, 0], [2, 2]])
    scorer = L.Scorer(model)
    for a in range(5):
        for b in range(5):
            s = (scorer.first[a] + scorer.second[b]).astype(float) @ word.T + bias
            assert abs(scorer.norm[a, b] - (s.max() + np.log(np.exp(s - s.max()).sum()))) < 1e-3


def test_scores_against_a_version_word_by_word(documents):
    texts = [*corpus(12, 8), "table " * 9 + "desk " * 7 + "lamp5 lamp6 Lampé"]
    model = L.train(documents(texts), 12, 4, 1)
    context, place, word, bias = (x.astype(float) for x in model.parts(model.parameters))
    got = {r["doc_id"]: r for r in L.score(documents(texts), model).collect()}
    for i, text in enumerate(texts):
        before, total, unknown = [model.size, model.size], 0.0, 0
        for w in text.lower().split():
            h = np.array([hash_of(w)], np.uint64)
            n = int(model.numbers(h)[0])
            s = (context[before[1]] @ place[0] + context[before[0]] @ place[1]) @ word.T + bias
            total += s[n] - s.max() - np.log(np.exp(s - s.max()).sum())
            if n == 0:
                at = int(model.tail_places(h)[0])
                raw = np.frombuffer(w.encode(), np.uint8)
                total += model.tail_share[at] if at >= 0 else model.rare + float(model.spelling.log_probabilities(raw, np.array([0]), np.array([len(raw)]))[0])
                unknown += at < 0
            before = [before[1], n]
        assert abs(got[i]["log_probability"] - total) < 1e-2 and got[i]["n_unknown"] == unknown


def test_the_list_of_words_grows_with_the_corpus(documents):
    lists = [len(L.train(documents([" ".join(f"v{i}" for i in range(n))] * L.LEAST), 8, 4, 1).tail) for n in (100, 1000)]
    assert lists == [93, 993]
