"""Near-duplicate groups by SimHash codes and an exact comparison of all of them, by tiles and bands of bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH, ID, components, id_back, one_each, row_key, written
from .tokens import hashed_words, mix64

#: Codes have 128 bits.
RADIUS = 26
#: The share of word triples in common from which about nine of ten pairs of texts are found.
FOUND_FROM = 0.6
#: Codes of a tile, about: 16 bytes each.
TILE = 1 << 20
#: A tile of so few codes has one band, so that all are compared; others have keys of so many codes, about, up to 16 bits.
_WHOLE, _SHARED = 4096, 96
#: Codes that are compared in one step, and pairs that are held before they are merged.
_LANE, _HELD = 32_768, 1 << 20
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.float32)


def code_of(words: np.ndarray) -> tuple[int, int]:
    """The 128-bit SimHash of a text of at least one word, as two unsigned numbers, over its sets of words and of adjacent pairs.

    The number of features is made odd by one that depends on all others: no bit is a tie, which would have to be settled
    one way and make codes of short texts alike.
    """
    pairs = np.unique(np.concatenate([words, words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:]]))
    if len(pairs) % 2 == 0:
        pairs = np.append(pairs, mix64(pairs).sum(keepdims=True))
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        body = mix64(pairs ^ np.uint64(salt)).view(np.uint8).reshape(len(pairs), 8)
        # how often each byte value stands in each of the 8 places, then bits from bytes by a matrix product
        seen = np.bincount((body + (np.arange(8) << 8)).ravel(), minlength=2048).reshape(8, 256)
        ones = seen.astype(np.float32) @ _BITS
        out.append(int(np.packbits(ones.ravel() * 2 > len(pairs), bitorder="little").view(np.uint64)[0]))
    return out[0], out[1]


def _codes(batches):
    for batch in batches:
        n = batch.num_rows
        lo, hi, has = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, bool)
        for first, words, bounds, *_ in hashed_words(batch.column(2), fold=True):
            for i in range(len(bounds) - 1):
                if bounds[i + 1] > bounds[i]:
                    has[first + i] = True
                    lo[first + i], hi[first + i] = code_of(words[bounds[i] : bounds[i + 1]])
        keep = pa.array(has)
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(2)), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64))], names=[ID, HASH, "lo", "hi"]).filter(keep)


def simhash_codes(docs: DataFrame) -> DataFrame:
    """(row id, row hash, lo, hi) of each row whose text has a word; the two halves of the code as signed numbers."""
    keyed = docs.where("text is not null").select(*row_key(), "text")
    return keyed.mapInArrow(_codes, f"{ID} bigint, {HASH} bigint, lo bigint, hi bigint")


def bands(codes: int, radius: int = RADIUS) -> list[tuple[int, int, int, int, int]]:
    """The bands that codes are parted into, by the number of codes of a tile: (place, width, most, seen, within).

    Bits place to place + width are the band's key.  Two codes within the radius have a band, counted around a ring,
    in which the key differs in `most` bits at most, and of the `seen` bits from its place on `within` at most.  For
    this let d be the differing bits of each band: the sum of d - most - 1 over all bands is at most
    radius - (radius - bands + 1) - bands = -1.  Of a ring of numbers with a sum below 0 all sums that begin after the
    last place where the sum from the start is largest are below 0.
    """
    count = 1 if codes <= _WHOLE else 128 // min(max((codes // _SHARED).bit_length(), 8), 16)
    widths = [128 // count + (i < 128 % count) for i in range(count)]
    most = [(radius - count + 1) // count + (i < (radius - count + 1) % count) for i in range(count)]
    out = []
    for i in range(count):
        seen, within = widths[i], most[i]
        for j in range(i + 1, i + count):
            if seen + widths[j % count] > 64:
                break
            seen, within = seen + widths[j % count], within + most[j % count] + 1
        out.append((sum(widths[:i]), widths[i], most[i], min(seen, 64), within))
    return out


def _by_key(codes: np.ndarray, place: int, width: int, seen: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of codes by a band's key, the bits seen in that order, and where each key begins; one key for all if no index would hold them."""
    x, y = (codes[:, place // 64], codes[:, 1 - place // 64])
    if place % 64:
        x = (x >> np.uint64(place % 64)) | (y << np.uint64(64 - place % 64))
    bits = x & np.uint64((1 << seen) - 1)
    if width > 16:
        return np.arange(len(bits)), np.ascontiguousarray(bits), np.array([0, len(bits)])
    key = (bits & np.uint64((1 << width) - 1)).astype(np.int64)
    order = np.argsort(key, kind="stable")
    return order, bits[order], np.concatenate([[0], np.cumsum(np.bincount(key, minlength=1 << width))])


def band_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool, band: tuple[int, int, int, int, int]):
    """Yield indexes (i, j) of all pairs of codes within `radius` bits that meet in the band; i < j if a and b are the same tile.

    a and b: n x 2 words.  Codes are sorted by the band's key; those of each key are compared with those of the keys
    that differ in as many bits as the band allows, by exclusive-or and bit count of the bits seen, then of all bits.
    All other keys are skipped.  Pairs come in parts, so that very many are never held at once.
    """
    place, width, most, seen, within = band
    order_a, bits_a, begin_a = _by_key(a, place, width, seen)
    order_b, bits_b, begin_b = (order_a, bits_a, begin_a) if same else _by_key(b, place, width, seen)
    keys = len(begin_a) - 1
    ball = np.flatnonzero(np.bitwise_count(np.arange(keys)) <= most)  # 0 is the first, if there is any
    word, count = np.empty(_LANE, np.uint64), np.empty(_LANE, np.uint8)
    found, held = [], 0

    def checked():
        p, q = (np.concatenate(x) for x in zip(*found, strict=True))
        p, q = order_a[p], order_b[q]
        if same:
            p, q = np.minimum(p, q), np.maximum(p, q)
        near = np.bitwise_count(a[p] ^ b[q]).sum(axis=1, dtype=np.int16) <= radius
        if same:
            near &= p < q
        return p[near], q[near]

    for key in np.flatnonzero(np.diff(begin_a)) if len(ball) else ():
        near = ball ^ key
        if same:
            near = near[near >= key]  # key stays the first
        start = begin_b[near]
        n = begin_b[near + 1] - start
        ends = np.cumsum(n)
        places = np.repeat(start - ends + n, n) + np.arange(ends[-1])
        others = bits_b[places]
        for i in range(begin_a[key], begin_a[key + 1], 64):
            own = bits_a[i : min(i + 64, begin_a[key + 1]), None]
            # the key's own codes apart: in one tile each is as near as can be to itself
            lane, j = _LANE // len(own), 0
            while j < len(others):
                stop = min(j + lane, len(others), *([n[0]] if same and j < n[0] else []))
                shape = (len(own), stop - j)
                w, d = (x[: shape[0] * shape[1]].reshape(shape) for x in (word, count))
                np.bitwise_xor(own, others[None, j:stop], out=w)
                np.bitwise_count(w, out=d)
                if int(d.min()) <= within:
                    p, q = np.divmod(np.flatnonzero(d <= within), stop - j)
                    found.append((p + i, places[q + j]))
                    held += len(p)
                    if held > _HELD:
                        yield checked()
                        found, held = [], 0
                j = stop
    if found:
        yield checked()


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of all pairs of codes within `radius` bits, each once; i < j if a and b are the same tile."""
    every = [i * len(b) + j for band in bands(max(len(a), len(b)), radius) for i, j in band_pairs(a, b, radius, same, band)]
    return np.divmod(np.unique(np.concatenate([np.zeros(0, np.int64), *every])), max(len(b), 1))


def _linked(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least node of each node's component, when nodes x and y are linked besides."""
    x, y = root[x], root[y]
    while (far := x != y).any():
        x, y = x[far], y[far]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
        x, y = root[x], root[y]
    return root


def near_links(codes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct codes (lo, hi) whose components are those of all pairs within the radius.

    Codes are written once, in tiles of about `tile` codes; each pair of tiles in each band is one row of a Cartesian
    product, which reads the tiles from the shared folder and shuffles no pairs.
    """
    count = codes.count()
    parts = max(1, -(-count // tile))
    parted = bands(min(count, tile), radius)

    def pack(batches):
        body, at = [], None
        for batch in batches:
            body.append(np.stack([np.asarray(batch.column(i)) for i in range(2)], axis=1))
            at = batch.column(2)[0].as_py() if at is None and batch.num_rows else at
        if at is None:
            return
        for k, part in enumerate(np.array_split(rows := np.concatenate(body), max(1, round(len(rows) / tile)))):
            yield pa.RecordBatch.from_arrays([pa.array([(at << 20) + k], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["t", "codes"])

    def compare(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                band, t, t2 = (batch.column(c)[k].as_py() for c in ("band", "t", "t2"))
                a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64).reshape(-1, 2) for c in ("codes", "codes2"))
                same = t == t2
                nodes = a if same else np.concatenate([a, b])
                root = np.arange(len(nodes))
                for i, j in band_pairs(a, b, radius, same, parted[band]):
                    root = _linked(root, i, j if same else j + len(a))
                far = np.flatnonzero(root != np.arange(len(root)))
                for i in range(0, len(far), _HELD):
                    p = far[i : i + _HELD]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[x, k].view(np.int64)) for x in (p, root[p]) for k in (0, 1)], names=["a0", "a1", "b0", "b1"])

    spread = codes.select("lo", "hi").repartitionByRange(parts, "lo", "hi").select("lo", "hi", F.spark_partition_id().cast("long").alias("at"))
    tiles = written(spread.mapInArrow(pack, "t bigint, codes binary"), "tiles")
    n = max(1, tiles.count())
    # a task for each tile and band, met by each other tile, as far as the scheduler bears it
    banded = tiles.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(parted) - 1))).alias("band")).repartitionByRange(min(n * len(parted), 4096), "t", "band")
    other = tiles.select(*(F.col(c).alias(c + "2") for c in tiles.columns)).repartitionByRange(min(n, 512), "t2")
    met = banded.crossJoin(other).where("t <= t2").select("band", "t", "t2", "codes", "codes2")
    found = met.mapInArrow(compare, "a0 bigint, a1 bigint, b0 bigint, b1 bigint")
    return found.select(*(F.struct(F.col(x + "0").alias("lo"), F.col(x + "1").alias("hi")).alias(x) for x in ("a", "b")))


def _keyed_groups(docs: DataFrame, radius: int, tile: int) -> DataFrame:
    """(row id, row hash, root id, root hash) of the rows that have a code; a root is the least row of its group."""
    codes = written(simhash_codes(docs), "codes")
    # equal codes are one group whatever the number of rows: only distinct codes are compared
    least = F.min(F.struct(ID, HASH)).alias("k")
    distinct = written(codes.groupBy("lo", "hi").agg(least), "distinct")
    roots = components(near_links(distinct.select("lo", "hi"), radius, tile))
    own = F.struct("lo", "hi")
    roots = roots.select(F.col("node.lo").alias("lo"), F.col("node.hi").alias("hi"), "root")
    grouped = distinct.join(roots, ["lo", "hi"], "left").select("lo", "hi", "k", F.coalesce("root", own).alias("root"))
    first = grouped.groupBy("root").agg(F.min("k").alias("first"))
    named = grouped.join(first, "root").select("lo", "hi", "first")
    return codes.join(named, ["lo", "hi"]).select(ID, HASH, F.col("first")[ID].alias("root_id"), F.col("first")[HASH].alias("root_hash"))


def near_groups(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, group_id, group_size) for each row: group_id is the least id that the row is linked to.

    Two rows are linked when their codes differ in `radius` bits at most; groups are the connected components over all
    pairs of rows, none left out.  Null texts and texts without a word are groups of their own (group_id is their id).
    Null ids come last in the order.  Repeated rows belong to one group and each counts.  Extra columns are ignored; an
    empty table gives an empty result.
    """
    keyed = written(_keyed_groups(docs, radius, tile), "groups")
    size = keyed.groupBy("root_id", "root_hash").agg(F.count("*").alias("group_size"))
    full = keyed.join(size, ["root_id", "root_hash"]).select(id_back(ID).alias("doc_id"), id_back("root_id").alias("group_id"), "group_size")
    bare = docs.where(_wordless()).select(F.col("doc_id").cast("long"), F.col("doc_id").cast("long").alias("group_id"), F.lit(1).cast("long").alias("group_size"))
    return full.unionByName(bare)


def _wordless():
    return F.col("text").isNull() | ~F.col("text").rlike(r"[^\t\n\f\r ]")


def drop_near_copies(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The rows of docs, all columns, with one row of each group of near_groups(): the one with the least id.

    Null texts and texts without a word stay.  Of rows that repeat id and text the least by all columns stays.
    """
    keyed = _keyed_groups(docs, radius, tile)
    lost = keyed.where(f"{ID} <> root_id or {HASH} <> root_hash").select(ID, HASH)
    stay = docs.where(~_wordless()).select("*", *row_key()).join(lost, [ID, HASH], "left_anti")
    return one_each(stay, [ID, HASH], docs.columns).unionByName(docs.where(_wordless()))
