"""Substring dedup: passages that an earlier document holds are cut, found by suffix automata of reference shards.

A run of at least MIN_WORDS words that also stands in an earlier document is cut.  Candidates come from winnowing: of
the hashes of all short word runs in a window of MIN_WORDS words the least is the window's anchor, so equal windows have
equal anchors wherever they stand, and windows whose anchor only one document has can't repeat.  Stretches of text
around shared anchors go to the shard of the earliest document that has the anchor.  There documents stream in order
through the shard's suffix automaton, whose matching statistics give the maximal matched spans, and what is new is
added to the automaton for the documents after it.  The anchors only decide where to look: cuts come from the automaton.

The reference grows with the corpus, so a shard's automaton is built where its candidates are routed to rather than
sent from the driver to everyone.  Where one anchor stands in very many documents, its stretches would be too many for
one task: their windows are then compared by 128-bit hashes, in aggregates that combine before they shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import HASH, ID, NO_ID, row_key, written
from .tokens import hashed_words, mix64, window_hashes

MIN_WORDS = 50
ANCHOR_WORDS = 12
#: Candidate words for one shard, on average, and of one owner at most: beyond that windows are compared by hashes.
SHARD_WORDS, OWNER_WORDS = 65_536, 1_048_576


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(words: np.ndarray, bounds: np.ndarray, min_words: int, anchor_words: int) -> tuple[np.ndarray, ...]:
    """(anchor, document, first word, end word) of each run of windows of one document that have one anchor.

    bounds[i]:bounds[i + 1] are the words of document i; places count from the document's first word, and end is that of
    the run's last window.
    """
    if len(words) < min_words:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    least = _sliding_min(window_hashes(words, anchor_words), min_words - anchor_words + 1)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places = np.flatnonzero(doc[: len(least)] == doc[min_words - 1 :])  # windows that lie in one document
    least, doc = least[places], doc[places]
    if not len(places):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.append(first[1:], len(places)) - 1
    start = bounds[doc[first]]
    return least[first], doc[first], places[first] - start, places[last] + min_words - start


def _anchor_rows(min_words: int, anchor_words: int):
    def run(batches):
        for batch in batches:
            for at, words, bounds, *_ in hashed_words(batch.column(2)):
                anchor, doc, s, e = anchors(words, bounds, min_words, anchor_words)
                if len(anchor):
                    rows = pa.array(doc + at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))],
                        names=["anchor", ID, HASH, "s", "e"],
                    )

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _stretches(batches):
    """Rows with the words of each stretch to look at, one for each owner of its anchors."""
    for batch in batches:
        places = batch.column(3).to_pylist()
        rows = []
        for at, words, bounds, *_ in hashed_words(batch.column(2)):
            for i in range(len(bounds) - 1):
                own = words[bounds[i] : bounds[i + 1]]
                by: dict[int, list[tuple[int, int]]] = {}
                for p in places[at + i]:
                    by.setdefault(p["owner"], []).append((p["s"], p["e"]))
                for owner, spans in by.items():
                    for s, e in _merged(spans):
                        rows.append((at + i, owner, s, (own[s:e] >> np.uint64(32)).astype(np.uint32).tobytes()))
        if rows:
            take = pa.array([r[0] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], names=["owner", ID, HASH, "s", "words"])


def shard_cuts(stretches: list[tuple[tuple, int, np.ndarray]], min_words: int) -> list[tuple[tuple, int, int]]:
    """(document, first word, end word) of each maximal span of a stretch that an earlier document's stretch holds.

    stretches: (document, place of the first word, words), sorted; stretches of one document don't see each other.
    """
    reference, out, i = SuffixAutomaton(), [], 0
    while i < len(stretches):
        j, new = i, []
        while j < len(stretches) and stretches[j][0] == stretches[i][0]:
            doc, at, words = stretches[j]
            words = words.tolist()
            long = np.flatnonzero(np.array(reference.statistics(words)) >= min_words)
            # windows are known by their last word; the new ones go into the reference
            known = np.zeros(len(words), bool)
            known[long] = True
            cuts = _merged([(int(p) - min_words + 1, int(p) + 1) for p in long])
            out += [(doc, at + s, at + e) for s, e in cuts]
            fresh = _merged([(int(p) - min_words + 1, int(p) + 1) for p in np.flatnonzero(~known[min_words - 1 :]) + min_words - 1])
            new += [words[s:e] for s, e in fresh]
            j += 1
        for words in new:
            reference.add(words)
        i = j
    return out


def _shards(min_words: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(ID, "ascending"), (HASH, "ascending"), ("s", "ascending")])
        ids, hashes, starts = (table[c].to_pylist() for c in (ID, HASH, "s"))
        words = [np.frombuffer(x.as_py(), np.uint32) for x in table["words"]]
        cuts = shard_cuts([((a, b), s, w) for a, b, s, w in zip(ids, hashes, starts, words, strict=True)], min_words)
        return pa.table({ID: pa.array([c[0][0] for c in cuts], pa.int64()), HASH: pa.array([c[0][1] for c in cuts], pa.int64()), "s": pa.array([c[1] for c in cuts], pa.int32()), "e": pa.array([c[2] for c in cuts], pa.int32())})

    return run


def _windows(min_words: int):
    """Two hashes of each window of the stretches, with the place of its first word."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column(4)[i].as_py(), np.uint32).astype(np.uint64)
                hashes = [window_hashes(w, min_words) for w in (words, mix64(words))]
                n = len(hashes[0])
                own = [pa.array(np.full(n, batch.column(k)[i].as_py(), np.int64)) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in hashes), *own, pa.array((batch.column(3)[i].as_py() + np.arange(n)).astype(np.int32))], names=["w0", "w1", ID, HASH, "s"])

    return run


def _cuts_by_hash(rows: DataFrame, min_words: int) -> DataFrame:
    """The cuts of stretches of any number: windows whose first holder is an earlier document."""
    windows = written(rows.mapInArrow(_windows(min_words), f"w0 bigint, w1 bigint, {ID} bigint, {HASH} bigint, s int"), "windows")
    row = F.struct(ID, HASH)
    first = written(windows.groupBy("w0", "w1").agg(F.min(row).alias("first"), F.max(row).alias("last")).where("first <> last").drop("last"), "holders")
    return windows.join(first, ["w0", "w1"]).where(row > F.col("first")).select(ID, HASH, "s", (F.col("s") + min_words).alias("e"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS, shard_words: int = SHARD_WORDS, owner_words: int = OWNER_WORDS) -> DataFrame:
    """(row id, row hash, spans) of the rows with repeated passages; spans: word places (s, e), overlapping ones too."""
    keyed = docs.where("text is not null").select(*row_key(), "text")
    marks = written(keyed.mapInArrow(_anchor_rows(min_words, anchor_words), f"anchor bigint, {ID} bigint, {HASH} bigint, s int, e int"), "anchors")
    # anchors of several documents, with the earliest as owner; written, so that the join below can split a hot anchor
    ends = marks.groupBy("anchor").agg(F.min(ID).alias("i"), F.max(ID).alias("j"), F.min(HASH).alias("k"), F.max(HASH).alias("l")).where("i <> j or k <> l")
    owners = written(ends.select("anchor", F.when(F.col("i") == NO_ID, F.col("anchor")).otherwise(F.xxhash64("i")).alias("owner")), "owners")
    # merged at every size: texts and anchors are then shuffled alike in small and large tables, and hot keys are split
    shared = marks.join(owners.hint("merge"), "anchor").select(ID, HASH, F.struct("owner", "s", "e").alias("p"))
    places = written(shared.groupBy(ID, HASH).agg(F.collect_set("p").alias("places")), "places")
    looked = keyed.join(places.hint("merge"), [ID, HASH]).select(ID, HASH, "text", "places")
    rows = written(looked.mapInArrow(_stretches, f"owner bigint, {ID} bigint, {HASH} bigint, s int, words binary"), "stretches")
    sizes = rows.groupBy("owner").agg((F.sum(F.octet_length("words")) / 4).alias("n"))
    hot = written(sizes.where(F.col("n") > owner_words).select("owner"), "hot")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0] // 4
    shards = max(1, total // shard_words)
    routed = rows.join(hot, "owner", "left_anti").select(F.pmod("owner", F.lit(shards)).alias("shard"), ID, HASH, "s", "words")
    cuts = routed.groupBy("shard").applyInArrow(_shards(min_words), f"{ID} bigint, {HASH} bigint, s int, e int")
    if not hot.isEmpty():
        cuts = cuts.unionByName(_cuts_by_hash(rows.join(hot, "owner", "left_semi"), min_words))
    return cuts.groupBy(ID, HASH).agg(F.collect_set(F.struct("s", "e")).alias("__spans"))


def _cut(text_at: int, spans_at: int):
    def run(batches):
        for batch in batches:
            texts, spans = batch.column(text_at), batch.column(spans_at)
            todo = np.flatnonzero(np.asarray(spans.is_valid()))
            if len(todo):
                out = texts.to_pylist()
                for at, _, bounds, starts, _, body, offsets in hashed_words(texts.take(pa.array(todo))):
                    for i in range(len(bounds) - 1):
                        row = int(todo[at + i])
                        own = starts[bounds[i] : bounds[i + 1]]
                        end = int(offsets[i + 1])
                        # a word goes with the white space after it
                        edge = np.append(own, end)
                        keep, last = [], int(offsets[i])
                        for s, e in _merged([(x["s"], x["e"]) for x in spans[row].as_py()]):
                            keep.append(body[last : edge[s]])
                            last = int(edge[e])
                        keep.append(body[last:end])
                        out[row] = b"".join(x.tobytes() for x in keep).decode()
                texts = pa.array(out, texts.type)
            columns = [texts if i == text_at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS, shard_words: int = SHARD_WORDS, owner_words: int = OWNER_WORDS) -> DataFrame:
    """The rows of docs, all columns, with repeated passages cut from text and n_chars (if there) counted again.

    A word is cut, with the white space after it, when it lies in a run of `min_words` words that a row with a lesser
    id also has; so the first holder of a passage keeps it, and repeats within one text stay.  Words are what ASCII
    white space parts.  Null ids come last in the order; of rows with one id the order is that of a hash of the text,
    and rows that repeat id and text are the same document.  No row goes: a text may become empty.  Null and short
    texts stay as they are; extra columns go along; names starting with two underscores are reserved.
    """
    spans = written(repeated_spans(docs, min_words, anchor_words, shard_words, owner_words), "spans")
    joined = docs.select("*", *row_key()).join(spans.hint("merge"), [ID, HASH], "left").select(*docs.columns, "__spans")
    names = joined.columns
    schema = joined.schema
    cut = joined.mapInArrow(_cut(names.index("text"), names.index("__spans")), schema).drop("__spans")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def oracle_sql(min_words: int = MIN_WORDS) -> str:
    """cut_repeats() over documents: every window of min_words words by value, without anchors or automata."""
    return f"""
        WITH w AS MATERIALIZED (
            SELECT doc_id, text, lang, source, regexp_extract_all(text, '[^\t\n\f\r ]+') AS ws, regexp_extract_all(text, '[^\t\n\f\r ]+[\t\n\f\r ]*') AS ps
            FROM documents),
        g AS MATERIALIZED (
            SELECT doc_id, i, list_aggregate(ws[i : i + {min_words - 1}], 'string_agg', ' ') AS win
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {min_words - 2})) AS i FROM w WHERE len(ws) >= {min_words})),
        r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS holder FROM g),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {min_words})) AS i FROM r WHERE holder < doc_id),
        cs AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
        o AS (
            SELECT w.doc_id, lang, source,
                   CASE WHEN gone IS NULL THEN text
                        ELSE regexp_extract(text, '^[\t\n\f\r ]*') || coalesce(list_aggregate(list_filter(ps, lambda x, k: NOT list_contains(gone, k)), 'string_agg', ''), '') END AS text
            FROM w LEFT JOIN cs ON w.doc_id = cs.doc_id)
        SELECT doc_id, text, lang, source, length(text) AS n_chars FROM o"""


__all__ = ["cut_repeats", "oracle_sql", "repeated_spans", "shard_cuts"]
