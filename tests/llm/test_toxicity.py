import random
import re

from pyspark.sql import functions as F

from lectern.llm import toxicity
from lectern.llm.toxicity import CLOSER, INSULT, INTENSE, LINK, NOT, OPENER, OTHER, REPORT, TARGET, THREAT, clause_score


def by_hand(symbols, weights):
    """The grammar read off its description, without states."""
    total, pending = 0.0, 0.0
    for i, (s, w) in enumerate(zip(symbols, weights, strict=True)):
        before = symbols[:i]
        factor = 0.4 if REPORT in before else 1.0
        negated = NOT in before[-3:] if i else False
        opened = i  # where the links before this word begin
        while opened and symbols[opened - 1] == LINK:
            opened -= 1
        phrase = opened > 0 and symbols[opened - 1] == OPENER
        if s in (INSULT, CLOSER):
            factor *= 1.5 if TARGET in before else 1.0
            if s == INSULT and (phrase or (i and symbols[i - 1] == INTENSE)):
                factor *= 1.25
            if s == INSULT or phrase:
                total += w * factor * (0.25 if negated else 1.0)
        elif s == THREAT:
            pending = w
        elif s == TARGET and THREAT in before[-3:] and pending:
            recent = before[-3:]
            last = max(j for j, x in enumerate(recent) if x == THREAT)
            if TARGET not in recent[last + 1 :]:
                total += pending * factor * (0.25 if negated else 1.0)
                pending = 0.0
    return total


def test_composed_transducers_against_rules():
    rng = random.Random(7)
    for _ in range(3000):
        symbols = [rng.choice([OTHER, OTHER, INSULT, THREAT, TARGET, NOT, REPORT, OPENER, OPENER, LINK, LINK, CLOSER, CLOSER, INTENSE]) for _ in range(rng.randrange(0, 9))]
        weights = [rng.choice([0.9, 1.0, 1.6]) if s in (INSULT, CLOSER, THREAT) else 0.0 for s in symbols]
        assert abs(clause_score(symbols, weights) - by_hand(symbols, weights)) < 1e-9, symbols


def scored_by_hand(text, learned):
    """(score, strongest, clauses) of a text, parted with regular expressions over characters."""
    classes = {}
    for symbol, words in ((LINK, toxicity.LINKS), (OPENER, toxicity.OPENERS), (INTENSE, toxicity.INTENSIFIERS), (TARGET, toxicity.TARGETS), (NOT, toxicity.NEGATIONS), (REPORT, toxicity.REPORTS)):
        classes |= {w: (symbol, 0.0) for w in words}
    for symbol, words in ((CLOSER, toxicity.CLOSERS), (THREAT, toxicity.THREATS), (INSULT, learned), (INSULT, toxicity.INSULTS)):
        classes |= {w: (symbol, x) for w, x in words.items()}
    text = re.sub("[\u2018\u2019\u02bc\uff07]", "'", (text or "").lower())
    scores, n = [], 0
    for clause in re.split("[\r\n!,.:;?\u2026\u3002\uff01\uff1f\uff0e\uff0c\u3001\u061f\u06d4\u0964]", text):
        words = re.findall(r"[^\W_]+(?:'[^\W_]+)*", clause)
        n += len(words)
        found = [classes.get(w, (OTHER, 0.0)) for w in words]
        scores.append(by_hand([f[0] for f in found], [f[1] for f in found]))
    return round(sum(scores) / max(n, 1), 6), max(scores), sum(x > 0 for x in scores)


def test_whole_documents_against_a_version_by_hand(documents):
    rng = random.Random(17)
    words = "you are an idiot \u201cidiot\u201d 'moron' aren\u2019t don't said kill them piece of shit son of a bitch complete utter waste of space É\u00e9 zorgle is the river Stra\u00dfe \u6f22\u5b57 42 --- '' O'Neil".split()
    marks = [" ", " ", " ", " ", ", ", ". ", "\u2014", " \u2013 ", "\n", "\u2026", "; ", "\u00a0", " \u00ab", "\u3002"]
    texts = ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    texts += ["you are an \u201cidiot\u201d", "You\u2014idiot", "you aren\u2019t an idiot", "you aren't an idiot", "IDIOT", "'", "''", "", None, "you piece of shit", "\u00c9TAT idiot"]
    got = {r["doc_id"]: r for r in toxicity.score(documents(texts), toxicity.Grammar({"zorgle": 1.0})).collect()}
    for i, text in enumerate(texts):
        score, most, clauses = scored_by_hand(text, {"zorgle": 1.0})
        assert abs(got[i]["score"] - score) < 2e-6 and abs(got[i]["strongest"] - most) < 1e-9 and got[i]["clauses"] == clauses, text
    assert got[300]["strongest"] > 0 and got[301]["strongest"] > 0 and got[302]["strongest"] == got[303]["strongest"] < got[304]["strongest"]


def test_short_words_and_words_of_other_scripts_are_learned(documents, spark):
    rows = [(i, "der fluss xq \u0160VABO ist" if i % 2 else "der fluss ist ruhig") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    assert set(toxicity.learn(documents(rows), labels).learned) == {"xq", "\u0161vabo"}


def test_clauses_not_words(documents):
    texts = ["You are an idiot and a moron, you scum.", "You are not an idiot.", "He said you are an idiot.", "I will kill you.", "They kill time in the garden. You wait.", "A quiet afternoon by the river.", None, "", "idiot"]
    got = {r["doc_id"]: r for r in toxicity.score(documents(texts), toxicity.Grammar()).collect()}
    s = {i: r["strongest"] for i, r in got.items()}
    assert s[0] > s[8] > 0 and s[1] < s[8] and 0 < s[2] < s[8] * 1.5 and s[3] > 0
    assert s[5] == s[6] == s[7] == 0 and not got[5]["toxic"] and not got[6]["toxic"] and got[0]["toxic"]


def test_learned_words_on_held_out_documents(documents, spark):
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(80)]
    bad = ["zorgle", "plimf"]

    def text(toxic):
        words = [rng.choice(plain) for _ in range(60)]
        for _ in range(4 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(bad)
        return " ".join(words)

    rows = [(i, text(i % 3 == 0)) for i in range(360)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(rows)
    grammar = toxicity.learn(docs, labels)
    assert set(bad) <= set(grammar.learned) and not set(plain) & set(grammar.learned)
    held = [r for r in toxicity.score(docs, grammar).collect() if r["doc_id"] >= 240]
    right = sum(r["toxic"] == (r["doc_id"] % 3 == 0) for r in held)
    assert right / len(held) > 0.95


def test_edges(documents, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    df = documents([(1, "you idiot moron scum idiot"), (1, "you idiot moron scum idiot"), (None, "fine"), (2, None), (3, "x " * 200_000)]).withColumns({"toxic": F.lit("t"), "score": F.lit(1)})
    grammar = toxicity.learn(df, none)
    kept = toxicity.drop_toxic(df, grammar)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, None]
    assert toxicity.score(df, grammar).count() == 5
    assert toxicity.score(documents([]), grammar).count() == 0
