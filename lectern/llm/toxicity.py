"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the symbols of a clause in step: insults, threats, targets, negation and reported speech.  Their
composition is built once as one table over product states; a clause's score is the weight that its path sums up, so
"you are no idiot" or "they said 'idiot'" weigh less than "you are an idiot", and "a complete waste of space" counts
though none of its words does.  The insult lexicon is a written seed plus words learned from labelled documents.

Learning and scoring part words alike: lower case, runs of letters, digits and inner apostrophes; typographic quotes,
dashes and stops count as their plain forms.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ID, bounded_batches
from .tokens import buffers, hash_of, hashed_words

#: Labelled documents used to learn words and the density threshold, at most.
MAX_LABELLED = 20_000
#: Evidence (a likelihood ratio statistic) that a word needs to enter the lexicon, and the least rate ratio.
MIN_EVIDENCE, MIN_RATIO = 28.0, 8.0
#: A clause of this score makes a document toxic by itself.
STRONG_CLAUSE = 2.4
#: Summed clause scores a word, where no labels set it.
DEFAULT_DENSITY = 0.008

INSULTS = {
    **dict.fromkeys("idiot idiots moron morons imbecile imbeciles scum scumbag scumbags bastard bastards asshole assholes bitch bitches cunt retard retards dickhead wanker vermin subhuman".split(), 1.6),
    **dict.fromkeys("stupid pathetic worthless disgusting loser losers dumb dumbass jerk jerks fool fools trash clown clowns filth filthy ugly lowlife degenerate parasite parasites garbage".split(), 1.0),
}
THREATS = {**dict.fromkeys("kill murder strangle slaughter exterminate".split(), 1.4), **dict.fromkeys("hurt stab shoot beat destroy burn punch hang".split(), 0.9)}
TARGETS = "you your yours yourself u ur he she they them those him his her their these people everyone".split()
NEGATIONS = "not no never neither nor cannot isn't aren't wasn't don't doesn't didn't won't ain't isnt arent dont without".split()
REPORTS = "said says say reported reports reportedly quoted quote quotes wrote writes claimed claims alleged allegedly called calls according accused".split()

OPENERS = "piece pieces waste wastes sack sacks load bag bags son sons bunch heap pile".split()
LINKS = "of a an the".split()
CLOSERS = dict.fromkeys("shit crap space skin oxygen turd turds manure excrement".split(), 1.4)
INTENSIFIERS = "complete total absolute utter utterly such fucking bloody damn damned goddamn stinking".split()

OTHER, INSULT, THREAT, TARGET, NOT, REPORT, OPENER, LINK, CLOSER, INTENSE = range(10)
_WORD_BREAK = np.ones(256, bool)
_WORD_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = False
_CLAUSE_END = np.zeros(256, bool)
_CLAUSE_END[[10, 13, 33, 44, 46, 58, 59, 63]] = True


# Each transducer: start state, and (state, symbol) -> (state, factor of what the symbol weighs, weight added).
def _insult(state, symbol):
    """A phrase ("piece of ...", "son of a ...") weighs what its closing word says; an intensifier before an insult adds a quarter."""
    if symbol == OPENER:
        return 1, 1.0, 0.0
    if symbol == LINK and state == 1:
        return 1, 1.0, 0.0
    if symbol == INTENSE:
        return 2, 1.0, 0.0
    if symbol == CLOSER:
        return 0, 1.0, (1.0 if state == 1 else 0.0)
    if symbol == INSULT:
        return 0, (1.0, 1.25, 1.25)[state], 0.0
    return 0, 1.0, 0.0


def _threat(state, symbol):
    """A threatening verb counts when its target follows within three words."""
    if symbol == THREAT:
        return 3, 0.0, 0.0
    if symbol == TARGET and state:
        return 0, 1.0, 1.0
    return max(0, state - 1), 1.0, 0.0


def _target(state, symbol):
    """Once a target was named, insults in the clause weigh half as much again."""
    return (1 if symbol == TARGET else state), (1.5 if state and symbol in (INSULT, CLOSER) else 1.0), 0.0


def _negation(state, symbol):
    """A negation takes away most of the weight of an insult or threat up to three words later."""
    if symbol == NOT:
        return 3, 1.0, 0.0
    return max(0, state - 1), (0.25 if state and symbol in (INSULT, CLOSER, TARGET, THREAT) else 1.0), 0.0


def _report(state, symbol):
    """After a verb of saying, the rest of the clause is somebody else's."""
    return (1 if symbol == REPORT else state), (0.4 if state else 1.0), 0.0


_PARTS = ((_insult, 3), (_threat, 4), (_target, 2), (_negation, 4), (_report, 2))


def _composed():
    """The product of the transducers: next state, factor for the symbol's own weight, whether a phrase or a threat ends."""
    sizes = [n for _, n in _PARTS]
    step = {}
    for state in itertools.product(*map(range, sizes)):
        for symbol in range(10):
            after, factor, ends = [], 1.0, 0.0
            for (part, _), own in zip(_PARTS, state, strict=True):
                new, f, added = part(own, symbol)
                after.append(new)
                factor *= f
                ends += added
            step[state, symbol] = tuple(after), factor, ends
    return step


STEP = _composed()
START = tuple(0 for _ in _PARTS)


def clause_score(symbols, weights) -> float:
    """The weight of one clause's path; weights are those of insults, closing words and threats, 0 for other words."""
    state, total, pending = START, 0.0, 0.0
    for symbol, weight in zip(symbols, weights, strict=True):
        state, factor, ends = STEP[state, symbol]
        if symbol == INSULT:
            total += weight * factor
        elif symbol == THREAT:
            pending = weight
        elif symbol == CLOSER:
            total += weight * factor * ends
        elif ends:
            total += pending * factor * ends
            pending = 0.0
    return total


@dataclass
class Grammar:
    """Words of each class with weights, and the density of clause scores from which a document is toxic."""

    learned: dict[str, float] = field(default_factory=dict)
    density: float = DEFAULT_DENSITY

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted word hashes, their symbols and weights."""
        classes = (LINK, LINKS), (OPENER, OPENERS), (INTENSE, INTENSIFIERS), (TARGET, TARGETS), (NOT, NEGATIONS), (REPORT, REPORTS)
        words = {w: (symbol, 0.0) for symbol, some in classes for w in some} | {w: (CLOSER, x) for w, x in CLOSERS.items()}
        words |= {w: (THREAT, x) for w, x in THREATS.items()} | {w: (INSULT, x) for w, x in self.learned.items()} | {w: (INSULT, x) for w, x in INSULTS.items()}
        rows = sorted((hash_of(w), s, x) for w, (s, x) in words.items())
        return np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int8), np.array([r[2] for r in rows])


_APOSTROPHES, _STOPS, _MARKS = "[\u2018\u2019\u02bc\uff07]", "[\u2026\u3002\uff01\uff1f\uff0e\uff0c\u3001\u061f\u06d4\u0964]", r"[^\x00-\x7f\p{L}\p{N}\p{M}]"


def plain(column: pa.Array) -> pa.Array:
    """Texts in lower case and with plain marks; an apostrophe that isn't inside a word becomes a blank.  Nulls become empty."""
    column = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    if (buffers(column)[1] >= 0x80).any():
        for marks, with_ in ((_APOSTROPHES, "'"), (_STOPS, "."), (_MARKS, " ")):
            column = pc.replace_substring_regex(column, marks, with_)
    offsets, data = buffers(column)
    data, offsets = data[offsets[0] : offsets[-1]].copy(), offsets - offsets[0]
    at = np.flatnonzero(data == 39)
    inside = ~_WORD_BREAK
    inside[39] = False
    edge = np.isin(at, offsets) | np.isin(at + 1, offsets) | ~inside[data[np.maximum(at - 1, 0)]] | ~inside[data[np.minimum(at + 1, len(data) - 1)]]
    data[at[edge]] = 32
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def _scores(column: pa.Array, table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text: summed clause scores, the largest clause score, matched clauses, words."""
    known, symbol_of, weight_of = table
    n = len(column)
    total, most, matched, words = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for first, hashes, bounds, starts, _, text, _ in hashed_words(plain(column), space=_WORD_BREAK):
        words[first : first + len(bounds) - 1] = np.diff(bounds)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        symbols = np.where(known[at] == hashes, symbol_of[at], OTHER)
        hit = np.flatnonzero((symbols == INSULT) | (symbols == THREAT) | (symbols == CLOSER))
        if not len(hit):
            continue
        weights = weight_of[at]
        ends = np.flatnonzero(_CLAUSE_END[text])
        # a clause is the run of words of one text between two clause ends
        clause = np.searchsorted(ends, starts)
        row = np.searchsorted(bounds, hit, "right") - 1
        done = -1
        for h, r in zip(hit.tolist(), row.tolist(), strict=True):
            if h < done:
                continue
            i = max(int(bounds[r]), int(np.searchsorted(clause, clause[h], "left")))
            done = min(int(bounds[r + 1]), int(np.searchsorted(clause, clause[h], "right")))
            score = clause_score(symbols[i:done].tolist(), weights[i:done].tolist())
            if score > 0:
                total[first + r] += score
                most[first + r] = max(most[first + r], score)
                matched[first + r] += 1
    return total, most, matched, words


def _labelled(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, toxic) of at most `bound` labelled documents, by the order of a hash of the id."""
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # `bound` rows of two numbers: small by a documented parameter
    return docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("__toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> Grammar:
    """A grammar with insult words learned from labelled documents and the density threshold that parts them best.

    A word of any length is learned when it stands in toxic documents far more often than in others (rate ratio and
    likelihood ratio statistic above the limits).  Null texts, ids and labels teach nothing; of several labels of one id
    the toxic one counts.  Without toxic or without clean labels, as in empty tables, the seed and the default threshold
    are used.
    """
    bounded_batches(docs.sparkSession)
    sample = _labelled(docs, labels, bound)

    def distinct(batches):
        """(word, toxic): the distinct words of each text."""
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for first, hashes, bounds, starts, ends, text, _ in hashed_words(plain(batch.column(0)), space=_WORD_BREAK):
                body, found, of = text.tobytes(), [], []
                for i in range(len(bounds) - 1):
                    own = np.unique(hashes[bounds[i] : bounds[i + 1]], return_index=True)[1] + bounds[i]
                    found += [body[s:e].decode() for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
                    of += [toxic[first + i]] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(of, pa.int64())], names=["w", "toxic"])

    counted = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(distinct, "w string, toxic bigint")
    counted = counted.groupBy("w").agg(F.sum((F.col("toxic") == 1).cast("long")).alias("t"), F.sum((F.col("toxic") != 1).cast("long")).alias("c")).where("t >= 5 and t > c")
    size = sample.agg(F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)), F.count("*")).first()
    toxic, clean = size[0], size[1] - size[0]
    if not toxic or not clean:
        return Grammar()
    share = toxic / (toxic + clean)
    learned = {}
    for w, t, c in counted.collect():  # words of the bounded sample that pass a first filter
        n = t + c
        ratio = (t / toxic) / ((c + 0.5) / (clean + 1))
        evidence = 2 * (t * math.log(t / (n * share)) + (c * math.log(c / (n * (1 - share))) if c else 0.0))
        if ratio >= MIN_RATIO and evidence >= MIN_EVIDENCE:
            learned[w] = 1.0
    grammar = Grammar(learned)
    table = grammar.table()

    def densities(batches):
        for batch in batches:
            total, _, _, words = _scores(batch.column(0), table)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(total / np.maximum(words, 1), 4)), batch.column(1).cast(pa.int64())], names=["d", "toxic"])

    rows = sample.mapInArrow(densities, "d double, toxic bigint").groupBy("d").agg(F.sum((F.col("toxic") == 1).cast("long")).alias("t"), F.count("*").alias("n")).orderBy("d").collect()
    best, grammar.density = -1.0, DEFAULT_DENSITY
    caught, flagged = toxic, toxic + clean
    for i, (d, t, n) in enumerate(rows):
        if d > 0 and (f1 := 2 * caught / (toxic + flagged)) > best:
            best, grammar.density = f1, (d + rows[i - 1][0]) / 2 if i else d / 2
        caught, flagged = caught - t, flagged - n
    return grammar


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, score, strongest, clauses, toxic) of each row.

    score: summed clause scores a word, rounded to 6 places; strongest: the largest clause score; clauses: matched
    clauses.  A row is toxic when score reaches the grammar's density or strongest reaches STRONG_CLAUSE.  Whole texts
    are read.  Null and empty texts, and texts of marks alone, score 0.  Repeated rows are scored each; extra columns are ignored; null ids stay.
    """
    bounded_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias(ID), "text")
    return keyed.mapInArrow(_scorer(grammar, False), "doc_id bigint, score double, strongest double, clauses bigint, toxic boolean")


def _scorer(grammar: Grammar, only_clean: bool):
    table, density = grammar.table(), grammar.density

    def run(batches):
        for batch in batches:
            total, most, matched, words = _scores(batch.column(batch.schema.get_field_index("text")), table)
            rate = np.round(total / np.maximum(words, 1), 6)
            toxic = (rate >= density) & (rate > 0) | (most >= STRONG_CLAUSE)
            if only_clean:
                yield batch.filter(pa.array(~toxic))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rate), pa.array(most), pa.array(matched), pa.array(toxic)], names=["doc_id", "score", "strongest", "clauses", "toxic"])

    return run


def drop_toxic(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows of docs, all columns, that score() doesn't call toxic.  Null and empty texts stay."""
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(_scorer(grammar, True), docs.schema)
