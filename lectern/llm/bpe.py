"""Byte-level BPE by recursive DuckDB queries, one connection for each partition.

Encoding: a text is parted into words by the tokenizer's pattern; each distinct word of a batch is encoded once.  The
words' bytes are rows (word, position, token).  A recursive query joins each token and its neighbour with the merge
table and contracts every word's leftmost pair of the least rank, until no word has a pair left.  Long words have a
query of their own that contracts all pairs of the least rank in a step, from the left.

Decoding: token rows join the vocabulary, and an ordered aggregation puts each text's bytes together.
"""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Words of one recursive query, and words that a partition remembers.
QUERY_WORDS, KEPT_WORDS = 40_000, 600_000
#: Bytes from which a word is parted where no token can reach across, is not remembered, and has queries of its own.
LONG = 256
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A tokenizer file in the JSON form of public byte-level vocabularies; set where the file lies elsewhere.
DEFAULT_VOCABULARY = os.environ.get("BYTE_BPE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")


def file_bytes(path: str) -> bytes:
    """A vocabulary file, of some megabytes: the driver reads it and sends it to the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _byte_of_character() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            out[chr(256 + n)] = b
            n += 1
    return out


@lru_cache(maxsize=4)
def vocabulary(path: str, data: bytes | None = None) -> tuple[dict[int, bytes], list[tuple[int, int, int]]]:
    """Bytes of each token id, and (left, right, merged) ids in the order of their ranks.

    A .tiktoken file has ranks only: the pair of a token is what the lower ranks leave of its bytes.  data: what the
    file holds, where it was read already.
    """
    data = file_bytes(path) if data is None else data
    if path.endswith(".tiktoken"):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = [bytes([b]) for b in token]
                while len(parts) > 2:
                    low = min(range(len(parts) - 1), key=lambda i: (r if (r := ranks.get(parts[i] + parts[i + 1], rank)) < rank else 1 << 60, i))
                    parts[low : low + 2] = [parts[low] + parts[low + 1]]
                merges.append((ranks[parts[0]], ranks[parts[1]], rank))
        return {r: t for t, r in ranks.items()}, merges
    model = json.loads(data)["model"]
    byte = _byte_of_character()
    ids = {t: i for t, i in model["vocab"].items() if all(c in byte for c in t)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    return {i: bytes(byte[c] for c in t) for t, i in ids.items()}, merges


ENCODE = """
WITH RECURSIVE step AS (
    SELECT word, pos, token, 0 AS n FROM start
    UNION ALL
    (WITH pair AS (
        SELECT word, pos, token, n, lead(token) OVER o AS follows, lead(pos) OVER o AS place
        FROM step WINDOW o AS (PARTITION BY word ORDER BY pos)),
     chosen AS (
        SELECT word, arg_min(pos, rank * 4294967296 + pos) AS pos, arg_min(place, rank * 4294967296 + pos) AS place, arg_min(merged, rank * 4294967296 + pos) AS merged
        FROM pair JOIN merge ON token = a AND follows = b GROUP BY word)
     SELECT pair.word, pair.pos, CASE WHEN pair.pos = chosen.pos THEN merged ELSE token END, n + 1
     FROM pair JOIN chosen ON pair.word = chosen.word WHERE pair.pos <> chosen.place)
), done AS (SELECT word, max(n) AS n FROM step GROUP BY word)
SELECT step.word, list(token ORDER BY pos) AS tokens FROM step JOIN done USING (word, n) GROUP BY step.word ORDER BY step.word
"""

#: One long piece: every token with the place of the next one and the merge of the two.  A step contracts the least
#: rank's pairs from the left and replaces the rows that this touches, so the table stays as long as the piece.
ENCODE_LONG = """
WITH RECURSIVE s(pos, token, next, rank, merged) USING KEY (pos) AS (
    SELECT pos, token, next, rank, merged FROM start LEFT JOIN merge ON a = token AND b = follows
    UNION
    (WITH low AS (SELECT pos, next, merged FROM recurring.s WHERE rank = (SELECT min(rank) FROM recurring.s)),
     run AS (SELECT pos, next, merged, sum(fresh) OVER (ORDER BY pos) AS run FROM (SELECT *, CASE WHEN lag(next) OVER (ORDER BY pos) = pos THEN 0 ELSE 1 END AS fresh FROM low)),
     chosen AS (SELECT pos, next AS gone, merged FROM run QUALIFY row_number() OVER (PARTITION BY run ORDER BY pos) % 2 = 1),
     new AS (SELECT chosen.pos, merged_token AS token, g.next FROM (SELECT pos, gone, merged AS merged_token FROM chosen) chosen JOIN recurring.s g ON g.pos = gone),
     touched AS (
        SELECT new.pos, new.token, new.next, coalesce(m.token, f.token) AS follows FROM new LEFT JOIN recurring.s f ON f.pos = new.next LEFT JOIN new m ON m.pos = new.next
        UNION ALL
        SELECT l.pos, l.token, l.next, new.token FROM recurring.s l JOIN new ON l.next = new.pos WHERE l.pos NOT IN (SELECT pos FROM chosen) AND l.pos NOT IN (SELECT gone FROM chosen))
     SELECT pos, token, next, merge.rank, merge.merged FROM touched LEFT JOIN merge ON a = token AND b = follows
     UNION ALL SELECT gone, -1, NULL, NULL, NULL FROM chosen)
)
SELECT token FROM s WHERE token >= 0 ORDER BY pos
"""

DECODE = """
SELECT text, string_agg(piece, '' ORDER BY pos) AS body FROM given JOIN vocabulary USING (token) GROUP BY text ORDER BY text
"""


class Coder:
    """The tables of one vocabulary in a DuckDB connection of its own."""

    def __init__(self, path: str = DEFAULT_VOCABULARY, data: bytes | None = None) -> None:
        import duckdb

        tokens, merges = vocabulary(path, data)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB"})
        merge = pa.table({"a": pa.array([m[0] for m in merges], pa.int32()), "b": pa.array([m[1] for m in merges], pa.int32()), "rank": pa.array(range(len(merges)), pa.int64()), "merged": pa.array([m[2] for m in merges], pa.int32())})
        # bytes as Latin-1 characters: DuckDB joins text, and a token may end inside a character
        words = pa.table({"token": pa.array(list(tokens), pa.int32()), "piece": pa.array([t.decode("latin-1") for t in tokens.values()])})
        self.db.register("merge_rows", merge)
        self.db.register("vocabulary_rows", words)
        self.db.execute("CREATE TABLE merge AS SELECT * FROM merge_rows")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")
        first = {t[0]: i for i, t in tokens.items() if len(t) == 1}
        self.byte = np.array([first[b] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.split = regex.compile(PATTERN).findall
        # pairs of bytes that stand side by side in some token: elsewhere a word falls apart into pieces of their own
        self.joined = np.zeros((256, 256), bool)
        for t in tokens.values():
            b = np.frombuffer(t, np.uint8)
            self.joined[b[:-1], b[1:]] = True
        made: dict[int, int] = {}
        for rank, (_, _, token) in enumerate(merges):
            made[token] = rank
        # where every token is made before it is used, contracting all pairs of the least rank at once changes nothing
        self.ordered = all(made.get(t, -1) < rank for rank, (a, b, _) in enumerate(merges) for t in (a, b))

    def words(self, words: list[str]) -> list[bytes]:
        """Token ids of each word, four bytes each."""
        raw = [w.encode() for w in words]
        if max(map(len, raw), default=0) < LONG or not self.ordered:
            return self._short(raw)
        parts = [self._pieces(r) if len(r) >= LONG else [r] for r in raw]
        pieces = list(dict.fromkeys(x for p in parts for x in p))
        short = [x for x in pieces if len(x) < LONG]
        ids = dict(zip(short, self._short(short), strict=True)) | {x: self._long(x) for x in pieces if len(x) >= LONG}
        return [b"".join([ids[x] for x in p]) for p in parts]

    def _pieces(self, word: bytes) -> list[bytes]:
        """The word parted between bytes that no token holds side by side; no merge reaches across."""
        b = np.frombuffer(word, np.uint8)
        at = [0, *(np.flatnonzero(~self.joined[b[:-1], b[1:]]) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(at, at[1:], strict=False)]

    def _long(self, word: bytes) -> bytes:
        token = self.byte[np.frombuffer(word, np.uint8)]
        pos = np.arange(len(token), dtype=np.int32)
        end = np.arange(len(token)) == len(token) - 1
        self.db.register("start", pa.table({"pos": pos, "token": token, "next": pa.array(pos + 1, mask=end), "follows": pa.array(np.append(token[1:], 0), pa.int32(), mask=end)}))
        got = self.db.sql(ENCODE_LONG).to_arrow_table()["token"].combine_chunks()
        self.db.unregister("start")
        return got.cast(pa.int32()).to_numpy(zero_copy_only=False).tobytes()

    def _short(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), QUERY_WORDS):
            raw = words[i : i + QUERY_WORDS]
            size = np.array([len(r) for r in raw])
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            data = np.frombuffer(b"".join(raw), np.uint8)
            word = np.repeat(np.arange(len(raw), dtype=np.int32), size)
            rows = pa.table({"word": word, "pos": (np.arange(len(data)) - np.repeat(start, size)).astype(np.int32), "token": self.byte[data]})
            self.db.register("start", rows)
            got = self.db.sql(ENCODE).to_arrow_table()["tokens"].combine_chunks()
            self.db.unregister("start")
            flat, ends = got.values.to_numpy().tobytes(), (got.offsets.to_numpy() * 4).tolist()
            out += [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out

    def encode(self, texts: list[str | None]) -> pa.Array:
        """Lists of token ids; a null text has a null list."""
        split = [self.split(t) if t else [] for t in texts]
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        new = list(dict.fromkeys(w for s in split for w in s if w not in known))
        known.update(zip(new, self.words(new), strict=True))
        rows = [b"".join([known[w] for w in s]) for s in split]
        for w in new:
            if len(w) >= LONG:
                del known[w]
        flat = np.frombuffer(b"".join(rows), np.int32)
        ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
        offsets = pa.array(ends.astype(np.int32), mask=np.array([*(t is None for t in texts), False]))
        return pa.ListArray.from_arrays(offsets, pa.array(flat))

    def decode(self, lists: pa.Array) -> list[str | None]:
        """Texts of lists of token ids; bytes that aren't UTF-8 become replacement characters."""
        size = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
        text = np.repeat(np.arange(len(lists), dtype=np.int32), size)
        start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
        self.db.register("given", pa.table({"text": text, "pos": (np.arange(len(text)) - np.repeat(start, size)).astype(np.int32), "token": lists.flatten().cast(pa.int32())}))
        got = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("given")
        out: list[str | None] = [None if n else "" for n in lists.is_null().to_pylist()]
        for i, body in zip(got["text"].to_pylist(), got["body"].to_pylist(), strict=True):
            out[i] = body.encode("latin-1").decode("utf-8", "replace")
        return out


@lru_cache(maxsize=2)
def coder(path: str, data: bytes | None = None) -> Coder:
    """One coder for a Python worker, with the words it has met."""
    return Coder(path, data)


@lru_cache(maxsize=2)
def counter(path: str = DEFAULT_VOCABULARY, data: bytes | None = None):
    """A function from a text to the number of tokens that encode() gives it, by a compiled library: no ids are kept."""
    import tiktoken

    tokens, merges = vocabulary(path, data)
    ranks = {t: i for i, t in enumerate(sorted(t for t in tokens.values() if len(t) == 1))}
    ranks |= {tokens[merged]: len(ranks) + i for i, (_, _, merged) in enumerate(merges)}
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(coder.encode_ordinary(text))


def encode(docs: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, tokens, n_tokens, same) of each row: the token ids of the whole text, and whether decoding gives it back.

    A null text has null tokens and n_tokens and a null `same`; an empty text has no tokens.  Special tokens' strings
    are ordinary text.  A word of any length is encoded whole: from LONG bytes on it is parted where no token of the
    vocabulary can reach across, and a piece that stays long has a query of its own, with a step for each distinct
    merge.  Repeated rows are encoded each; extra columns are ignored; an empty table gives an empty result.
    """

    sent = docs.sparkSession.sparkContext.broadcast(file_bytes(path))

    def run(batches):
        own = coder(path, sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                texts = part.column(1).to_pylist()
                ids = own.encode(texts)
                back = [t for k in range(0, len(ids), 512) for t in own.decode(ids.slice(k, 512))]
                count = pa.array([None if t is None else n for t, n in zip(texts, pa.compute.list_value_length(ids).to_pylist(), strict=True)], pa.int64())
                same = pa.array([None if t is None else t == b for t, b in zip(texts, back, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, count, same], names=["doc_id", "tokens", "n_tokens", "same"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, tokens array<int>, n_tokens bigint, same boolean")


def decode(encoded: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, text) from (doc_id, tokens); null tokens give a null text, and an unknown id adds nothing."""

    sent = encoded.sparkSession.sparkContext.broadcast(file_bytes(path))

    def run(batches):
        own = coder(path, sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.decode(part.column(1)), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "tokens").mapInArrow(run, "doc_id bigint, text string")
