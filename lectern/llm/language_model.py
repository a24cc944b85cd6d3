"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

The two words before a word give a predicted vector, a sum of their vectors through one matrix for each place; its
product with a word's vector, plus the word's bias, is the word's score.  Training is data parallel: every partition
goes over all of its words from the same parameters, and the partitions' parameters are averaged, weighted by words.
Scoring normalises over the whole vocabulary with batched matrix products.

Words without a vector of their own are predicted together, as number 0, and then told apart: a word that the corpus
has LEAST times or more has its own share of them, and all others are spelt byte by byte.  So the list of words grows
with the corpus, and every word has a likelihood of its own; only the words with vectors are as many for any input.
The list is sent to the tasks up to LISTED_WORDS words; a longer one stays a table that the words of texts are joined to.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, written
from .tokens import fold_case, hashed_words

#: Words with a vector of their own; all others are predicted as number 0 and told apart by share or spelling.
VOCABULARY, DIMENSION, ROUNDS = 2048, 32, 2
#: How often a word without a vector must occur to have its own share; rarer words are spelt.
LEAST = 5
#: Words of the list, of 12 bytes each, that are sent to every task at most.
LISTED_WORDS = 4_000_000
BATCH, NOISE, STEP = 2048, 64, 0.3
_BLOCKS, _TOGETHER = 64, 256


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their counts."""
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, counts, len(codes)).astype(np.int64)


def spelt(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the words in lower case and an edge (256) after each, a code of it and the two before; the words' first places."""
    n = ends - starts + 1
    first = np.cumsum(n) - n
    symbols = np.full(n.sum(), 256, np.int64)
    at = np.ones(len(symbols), bool)
    at[first + n - 1] = False
    symbols[at] = fold_case(text[(np.arange(len(symbols)) - np.repeat(first - starts, n))[at]])
    one, two = np.full(len(symbols), 256), np.full(len(symbols), 256)
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    two[first] = 256
    return (two * 257 + one) * 257 + symbols, first


class Spelling:
    """Probabilities of words byte by byte from the two bytes before, from how often each code of spelt() was seen.

    What a pair of bytes was never followed by is left to the last byte alone, that to the byte's own share, and that to
    equal shares, each by the number of distinct followers; the probabilities of what may follow sum to one.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        pair, symbol = codes // 257, codes % 257
        n1 = np.bincount(symbol, counts, 257)
        kinds = (n1 > 0).sum()
        share = (n1 + kinds / 257) / (n1.sum() + kinds)
        n2 = np.bincount(pair % 257 * 257 + symbol, counts, 257 * 257).reshape(257, 257)
        kinds, total = (n2 > 0).sum(axis=1, keepdims=True), n2.sum(axis=1, keepdims=True)
        self.by_last = np.where(total > 0, (n2 + kinds * share) / np.maximum(total + kinds, 1), share)
        total, kinds = np.bincount(pair, counts, 257 * 257), np.bincount(pair, minlength=257 * 257)
        self.left = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
        self.codes, self.seen = codes, counts / (total + kinds)[pair]

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        pair, symbol = codes // 257, codes % 257
        return np.where(self.codes[at] == codes, self.seen[at], 0.0) + self.left[pair] * self.by_last[pair % 257, symbol]

    def log_probabilities(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each word."""
        if not len(starts):
            return np.zeros(0)
        codes, first = spelt(text, starts, ends)
        return np.add.reduceat(np.log(self.probabilities(codes)), first)


@dataclass
class Model:
    """known: sorted word hashes and number_of: their numbers; share: each number's share of all words.

    tail: sorted hashes of the words of number 0 that have their own share of it, whose logarithms are tail_share; where
    they are too many, listed is a table (word, share) of them; rare: the logarithm of what is left for all other words;
    spelling: how those are told apart, None if the corpus has none.
    """

    known: np.ndarray
    number_of: np.ndarray
    share: np.ndarray
    parameters: np.ndarray
    dimension: int = DIMENSION
    tail: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    tail_share: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    rare: float = 0.0
    spelling: Spelling | None = None
    listed: DataFrame | None = None

    @property
    def size(self) -> int:
        return len(self.share)

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Views of context vectors (with one more for "before the text"), place matrices, word vectors and biases."""
        v, d = self.size, self.dimension
        at = np.cumsum([(v + 1) * d, 2 * d * d, v * d])
        return flat[: at[0]].reshape(v + 1, d), flat[at[0] : at[1]].reshape(2, d, d), flat[at[1] : at[2]].reshape(v, d), flat[at[2] :]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.number_of[at], 0).astype(np.int32)

    def tail_places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each word stands in the tail; -1 where it doesn't."""
        if not len(self.tail):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.tail, hashes), len(self.tail) - 1)
        return np.where(self.tail[at] == hashes, at, -1)

    def within(self, numbers: np.ndarray, hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word its log-probability among the words of its number, and whether it is in no list."""
        out, missing = np.zeros(len(numbers)), np.zeros(len(numbers), bool)
        zero = np.flatnonzero(numbers == 0)
        place = self.tail_places(hashes[zero])
        out[zero[place >= 0]] = self.tail_share[place[place >= 0]]
        rare = zero[place < 0]
        missing[rare], out[rare] = True, self.rare
        if self.spelling is not None:
            out[rare] += self.spelling.log_probabilities(text, starts[rare], ends[rare])
        return out, missing

    def contexts(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words one and two before each word; the number past the last stands for "before the text"."""
        one, two = np.full(len(numbers), self.size, np.int32), np.full(len(numbers), self.size, np.int32)
        one[1:], two[2:] = numbers[:-1], numbers[:-2]
        first = bounds[:-1][np.diff(bounds) > 0]
        one[first] = two[first] = self.size
        second = bounds[:-1][np.diff(bounds) > 1] + 1
        two[second] = self.size
        return one, two


def start(hashes: list[int], counts: list[int], total: int, dimension: int = DIMENSION) -> Model:
    """A model of the given words, most frequent first, that begins as the unigram model."""
    unknown = max(0, total - sum(counts))
    share = np.array([unknown + 1, *counts], float)
    share /= share.sum()
    raw = np.array(hashes, np.int64).view(np.uint64)
    order = np.argsort(raw)
    v = len(share)
    rng = np.random.default_rng(7)
    flat = np.concatenate([rng.normal(0, 0.1, (v + 1) * dimension), np.tile(np.eye(dimension).ravel() * 0.5, 2), rng.normal(0, 0.1, v * dimension), np.log(share)])
    return Model(raw[order], (order + 1).astype(np.int32), share, flat.astype(np.float32), dimension)


def _gather(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sum of their rows."""
    order = np.argsort(ids.astype(np.uint16) if ids.max(initial=0) < 65_536 else ids, kind="stable")  # two bytes are sorted by radix
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return ids[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Minibatches of noise-contrastive estimation with steps scaled by past gradients."""

    def __init__(self, model: Model, seed: list[int], batch: int = BATCH) -> None:
        self.model, self.flat, self.batch = model, model.parameters.copy(), batch
        self.past = np.full(len(self.flat), 1e-2, np.float32)
        self.rng, self.words = np.random.default_rng(seed), 0
        self.edges = np.cumsum(model.share)
        self.log_noise = np.log(model.share * NOISE).astype(np.float32)
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        """One minibatch; the noise words are drawn from the word shares and shared by the batch."""
        context, place, word, bias = self.model.parts(self.flat)
        p_context, p_place, p_word, p_bias = self.model.parts(self.past)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), self.model.size - 1)
        d = self.model.dimension
        before, q, others_word = np.concatenate([context[one], context[two]], axis=1), word[target], word[noise]
        both = place.reshape(2 * d, d)  # the two places' matrices, one above the other
        predicted = before @ both
        score = np.einsum("ij,ij->i", predicted, q) + bias[target] - self.log_noise[target]
        others = predicted @ others_word.T + (bias[noise] - self.log_noise[noise])
        g = -1 / (1 + np.exp(np.clip(score, -30, 30)))  # of the loss, by the target's score
        h = 1 / (1 + np.exp(-np.clip(others, -30, 30, out=others)))  # by each noise word's
        back = g[:, None] * q + h @ others_word
        scale = np.float32(1 / len(target))

        def step(values, past, at, gradient):
            gradient = gradient * scale
            past[at] += gradient * gradient
            values[at] -= np.float32(STEP) * gradient / np.sqrt(past[at])

        rows = np.empty((len(target) + NOISE, d + 1), np.float32)  # of word vectors, with those of biases in the last column
        np.multiply(g[:, None], predicted, out=rows[: len(target), :d])
        rows[: len(target), d] = g
        rows[len(target) :, :d], rows[len(target) :, d] = h.T @ predicted, h.sum(axis=0)
        ids, rows = _gather(np.concatenate([target, noise]), rows)
        by_place = (before.T @ back).reshape(2, d, d)
        by_context = back @ both.T
        contexts, by_context = _gather(np.concatenate([one, two]), np.concatenate([by_context[:, :d], by_context[:, d:]]))
        step(word, p_word, ids, rows[:, :d])
        step(bias, p_bias, ids, rows[:, d])
        step(place, p_place, slice(None), by_place)
        step(context, p_context, contexts, by_context)
        self.words += len(target)

    def text(self, hashes: np.ndarray, bounds: np.ndarray) -> None:
        numbers = self.model.numbers(hashes)
        one, two = self.model.contexts(numbers, bounds)
        for i in range(0, len(numbers), self.batch):
            to = slice(i, i + self.batch)
            self.learn(one[to], two[to], numbers[to])

    def spell(self, hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Count the spellings of the distinct words of number 0."""
        words = np.unique(hashes, return_index=True)[1]
        words = words[self.model.numbers(hashes[words]) == 0]
        if len(words):
            codes, counts = np.unique(spelt(text, starts[words], ends[words])[0], return_counts=True)
            self.codes, self.counts = _summed(np.concatenate([self.codes, codes]), np.concatenate([self.counts, counts]))


class Scorer:
    """Normalised log-probabilities.

    A score is a sum of what each of the two context words gives, so its exponential is a product, and the sums over all
    words for all pairs of context words are one matrix product.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        context, place, self.word, self.bias = model.parts(model.parameters)
        self.first, self.second = context @ place[0], context @ place[1]
        a, b = self.first @ self.word.T, self.second @ self.word.T + self.bias
        most_a, most_b = a.max(axis=1), b.max(axis=1)
        sums = np.exp(a - most_a[:, None]) @ np.exp(b - most_b[:, None]).T
        with np.errstate(divide="ignore"):
            self.norm = np.log(sums) + most_a[:, None] + most_b
        for i, j in zip(*np.nonzero(sums < 1e-25), strict=True):  # too small for the product: summed apart
            s = a[i] + b[j]
            self.norm[i, j] = s.max() + np.log(np.exp(s - s.max()).sum())

    def normalisers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.norm[one, two]

    def log_probabilities(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        one, two = self.model.contexts(numbers, bounds)
        out = np.empty(len(numbers))
        for i in range(0, len(numbers), 65_536):
            a, b, w = one[i : i + 65_536], two[i : i + 65_536], numbers[i : i + 65_536]
            out[i : i + 65_536] = np.einsum("ij,ij->i", self.first[a] + self.second[b], self.word[w]) + self.bias[w] - self.normalisers(a, b)
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word, by its hash, stands in all texts."""

    def run(batches):
        for batch in batches:
            found = [words for _, words, *_ in hashed_words(batch.column(0), fold=True)]
            words, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.where("text is not null").select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, vocabulary: int = VOCABULARY, dimension: int = DIMENSION, rounds: int = ROUNDS, batch: int = BATCH, listed_words: int = LISTED_WORDS) -> Model:
    """A model of all words of all texts: counts first, then `rounds` passes of training and averaging.

    Null texts and texts without a word teach nothing; repeated rows count each.  Of an empty table comes a model of one
    class of words, whose spelling is unknown.
    """
    spark = docs.sparkSession
    counts = written(word_counts(docs), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.orderBy(F.desc("n"), "word").limit(vocabulary - 1).collect()  # as many as the vocabulary has words
    model = start([r["word"] for r in top], [r["n"] for r in top], total, dimension)
    unknown = total - sum(r["n"] for r in top)
    if len(top) == vocabulary - 1:  # else every word has a vector
        last_n, last_word = top[-1]["n"], top[-1]["word"]
        listed = counts.where((F.col("n") >= LEAST) & ((F.col("n") < last_n) | (F.col("n") == last_n) & (F.col("word") > last_word)))
        listed = listed.select("word", "n", F.log(F.col("n") / F.lit(unknown + 1)).cast("float").alias("share"))
        size, has = listed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        model = replace(model, rare=float(np.log((unknown - has + 1) / (unknown + 1))))
        if size > listed_words:
            model = replace(model, listed=written(listed.select("word", "share"), "listed"))
        else:
            rows = listed.orderBy("word").toArrow()  # `listed_words` of 16 bytes at most
            hashes = np.asarray(rows["word"].combine_chunks()).view(np.uint64)
            order = np.argsort(hashes)
            model = replace(model, tail=hashes[order], tail_share=np.asarray(rows["share"].combine_chunks())[order])
    texts = docs.where("text is not null").select("text")
    for k in range(rounds if total else 0):
        # the size of what is sent is set by vocabulary and dimension alone
        sent = spark.sparkContext.broadcast(replace(model, tail=model.tail[:0], tail_share=model.tail_share[:0], spelling=None, listed=None))

        def learn(batches, k=k, sent=sent):
            from pyspark import TaskContext

            at = TaskContext.get().partitionId()
            trainer = Trainer(sent.value, [k, at], batch)
            for some in batches:
                for _, hashes, bounds, starts, ends, text, _ in hashed_words(some.column(0), fold=True):
                    trainer.text(hashes, bounds)
                    if k == 0:
                        trainer.spell(hashes, text, starts, ends)
            if trainer.words:
                bodies = dict(enumerate(np.array_split(trainer.flat, _BLOCKS)))
                for block in np.unique(trainer.codes % _BLOCKS):
                    own = trainer.codes % _BLOCKS == block
                    bodies[_BLOCKS + int(block)] = np.stack([trainer.codes[own], trainer.counts[own]])
                yield pa.RecordBatch.from_arrays([pa.array(list(bodies), pa.int32()), pa.array([at] * len(bodies), pa.int32()), pa.array([trainer.words] * len(bodies), pa.int64()), pa.array([b.tobytes() for b in bodies.values()], pa.binary())], names=["block", "at", "words", "body"])

        def average(table: pa.Table) -> pa.Table:
            """Of bodies of one block: parameters are averaged by words, counts of spellings are summed."""
            table = table.sort_by("at")
            if table["block"][0].as_py() >= _BLOCKS:
                codes, counts = np.concatenate([np.frombuffer(b.as_buffer(), np.int64).reshape(2, -1) for b in table["body"]], axis=1)
                return pa.table({"block": table["block"][:1], "at": table["at"][:1], "words": table["words"][:1], "body": pa.array([np.stack(_summed(codes, counts)).tobytes()], pa.binary())})
            total, words = 0.0, 0
            for n, body in zip(table["words"].to_pylist(), table["body"], strict=True):
                total, words = total + n * np.frombuffer(body.as_buffer(), np.float32).astype(float), words + n
            return pa.table({"block": table["block"][:1], "at": table["at"][:1], "words": pa.array([words], pa.int64()), "body": pa.array([(total / words).astype(np.float32).tobytes()], pa.binary())})

        schema = "block int, at int, words bigint, body binary"
        learned = texts.mapInArrow(learn, schema)
        # two steps, so that no task holds the parameters of all partitions
        some = learned.groupBy("block", F.floor(F.col("at") / _TOGETHER)).applyInArrow(average, schema)
        blocks = some.groupBy("block").applyInArrow(average, schema).orderBy("block").collect()
        model = replace(model, parameters=np.concatenate([np.frombuffer(b["body"], np.float32) for b in blocks if b["block"] < _BLOCKS]))
        if spellings := [np.frombuffer(b["body"], np.int64).reshape(2, -1) for b in blocks if b["block"] >= _BLOCKS]:
            codes, counts = np.concatenate(spellings, axis=1)
            order = np.argsort(codes)
            model = replace(model, spelling=Spelling(codes[order], counts[order]))
        sent.unpersist()
    return model


_SCORERS: dict[str, Scorer] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, n_unknown, log_probability, perplexity) of each row, natural logarithms.

    log_probability is the sum over all words of the whole text, rounded to 4 places; n_unknown counts the words that
    are in no list of the model, which are scored by their spelling (as one word if the corpus of the model had no such
    words, so that there was no spelling to learn); perplexity is exp(-log_probability / n_words).  Null texts have null
    counts and scores; texts without a word have 0 words, log-probability 0 and a null perplexity.  Repeated rows are
    scored each; extra columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    sent, name = docs.sparkSession.sparkContext.broadcast(replace(model, listed=None)), uuid.uuid4().hex
    apart = model.listed is not None

    def run(batches):
        if name not in _SCORERS:  # a worker that is used again keeps its normalisers
            _SCORERS.clear()
            _SCORERS[name] = Scorer(sent.value)
        scorer = _SCORERS[name]
        for batch in batches:
            n = batch.num_rows
            words, unknown, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            open_words, open_spelt, open_count = [], [], np.zeros(n, np.int64)
            for first, hashes, bounds, starts, ends, text, _ in hashed_words(batch.column(1), fold=True):
                numbers = scorer.model.numbers(hashes)
                within, missing = scorer.model.within(numbers, hashes, text, starts, ends)
                to = slice(first, first + len(bounds) - 1)
                if apart:  # words of number 0 stay open: they are looked up in the table
                    zero = np.flatnonzero(numbers == 0)
                    open_words.append(hashes[zero].view(np.int64))
                    open_spelt.append(within[zero].astype(np.float32))
                    open_count[to] = np.diff(np.searchsorted(zero, bounds))
                    within[zero], missing[zero] = 0, False
                sums = np.concatenate([[0], np.cumsum(scorer.log_probabilities(numbers, bounds) + within)])
                missing = np.concatenate([[0], np.cumsum(missing)])
                words[to], unknown[to], total[to] = np.diff(bounds), np.diff(missing[bounds]), np.diff(sums[bounds])
            null = np.asarray(batch.column(1).is_null())
            columns = [batch.column(0), pa.array(words, mask=null), pa.array(unknown, mask=null), pa.array(total, mask=null)]
            if apart:
                at = pa.array(np.concatenate([[0], np.cumsum(open_count)]).astype(np.int32))
                lists = ((np.concatenate(x) if x else np.zeros(0, t)) for x, t in ((open_words, np.int64), (open_spelt, np.float32)))
                columns += [batch.column(2), *(pa.ListArray.from_arrays(at, pa.array(x)) for x in lists)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_unknown", "total", "u", "open", "spelt"][: len(columns)])

    schema = "doc_id bigint, n_words bigint, n_unknown bigint, total double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if apart:
        scored = written(rows.withColumn("u", F.monotonically_increasing_id()).mapInArrow(run, schema + ", u bigint, open array<bigint>, spelt array<float>"), "scored")
        found = scored.select("u", F.explode(F.arrays_zip("open", "spelt")).alias("x")).select("u", F.col("x.open").alias("word"), F.col("x.spelt").cast("double").alias("spelt"))
        found = found.join(model.listed, "word", "left").groupBy("u").agg(F.sum(F.coalesce(F.col("share").cast("double"), "spelt")).alias("more"), F.count_if(F.col("share").isNull()).alias("missing"))
        scored = scored.drop("open", "spelt").join(found, "u", "left")
        scored = scored.select("doc_id", "n_words", F.coalesce(F.col("missing") + F.col("n_unknown"), "n_unknown").alias("n_unknown"), F.coalesce(F.col("total") + F.col("more"), "total").alias("total"))
    else:
        scored = rows.mapInArrow(run, schema)
    perplexity = F.when(F.col("n_words") > 0, F.round(F.exp(-F.col("total") / F.col("n_words")), 4))
    return scored.select("doc_id", "n_words", "n_unknown", F.round("total", 4).alias("log_probability"), perplexity.alias("perplexity"))
