"""Exact top-k neighbours of binary codes by incremental multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K = 10
#: The stated set of queries: every row whose id this number divides.
EVERY = 50
#: Codes in one index, and queries that are put to it together.
SHARD, QUERIES = 65_536, 8_192
_AT_ONCE = 1 << 20
_FAR = np.int64((1 << 63) - 1)


def codes_of(vectors: np.ndarray) -> np.ndarray:
    """Sign bits of n x d vectors as n x ceil(d / 16) 16-bit segments: 1 where a value is above 0."""
    n, d = vectors.shape
    bits = np.zeros((n, -(-d // 16) * 16), np.uint8)
    bits[:, :d] = vectors > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


class Index:
    """Rows by the value of each segment: row numbers sorted by value, and where each value begins."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.begin = [np.concatenate([[0], np.cumsum(np.bincount(codes[:, j], minlength=65_536))]) for j in range(codes.shape[1])]


def _masks(radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(16), radius)], np.uint16)


def top_k(index: Index, queries: np.ndarray, own: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distances and rows (n x k, -1 where there are fewer) of the k nearest codes to each query, by distance, then row.

    own: the row of the index that is the query itself and doesn't count, or -1; limit: a distance for each query that
    codes further away needn't be found at.  Step t searches segment t mod m at radius t div m.  After it, every code
    within distance t has been seen: a code further than the radius searched in each segment differs in more than t
    bits.  A query ends when its k-th distance, or its limit, is within t.
    """
    n, m = queries.shape
    size = len(index.codes)
    none = np.int64(1) << 62
    best = np.full((n, k), none)  # distance and row in one number
    active = np.arange(n)
    limit = np.full(n, 17 * m, np.int64) if limit is None else limit
    for t in range(17 * m):
        j, radius = t % m, t // m
        masks = _masks(radius)
        begin, rows = index.begin[j], index.rows[j]
        step = max(1, _AT_ONCE // max(len(masks), 1 + len(masks) * size // 65_536))
        for at in range(0, len(active), step):
            q = active[at : at + step]
            keys = (queries[q, j][:, None] ^ masks[None]).astype(np.int64)
            first = begin[keys].ravel()
            count = begin[keys + 1].ravel() - first
            for lo, hi in _pieces(count):
                c, f = count[lo:hi], first[lo:hi]
                total = int(c.sum())
                if not total:
                    continue
                place = np.repeat(f - np.concatenate([[0], np.cumsum(c)[:-1]]), c) + np.arange(total)
                who = q[np.repeat(np.arange(lo, hi), c) // len(masks)]
                found = rows[place]
                apart = np.bitwise_count(queries[who] ^ index.codes[found]).astype(np.int64)
                distance = apart.sum(axis=1)
                # a code turns up once for each segment that is near enough: only its first step counts
                new = ((apart * m + np.arange(m)).min(axis=1) == t) & (found != own[who])
                key = distance * (1 << 40) + found
                new &= (key < best[who, k - 1]) & (distance <= limit[who])
                _insert(best, who[new], key[new], k)
        active = active[(best[active, k - 1] >= (np.int64(t + 1) << 40)) & (limit[active] > t)]
        if not len(active):
            break
    empty = best == none
    return np.where(empty, -1, best >> 40), np.where(empty, -1, best & ((1 << 40) - 1))


def _pieces(count: np.ndarray):
    """Runs of the list whose counts come to about _AT_ONCE."""
    sums = np.cumsum(count)
    lo = 0
    while lo < len(count):
        hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + _AT_ONCE, "right")))
        yield lo, hi
        lo = hi


def _insert(best: np.ndarray, who: np.ndarray, key: np.ndarray, k: int) -> None:
    if not len(who):
        return
    order = np.lexsort((key, who))
    who, key = who[order], key[order]
    some, start = np.unique(who, return_index=True)
    rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
    near = rank < k
    fresh = np.full((len(some), k), np.int64(1) << 62)
    fresh[np.searchsorted(some, who[near]), rank[near]] = key[near]
    best[some] = np.sort(np.concatenate([best[some], fresh], axis=1), axis=1)[:, :k]


class Nearest:
    """The k nearest of one block of queries over the indexes that were searched so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.distance, self.ids = np.full((queries, k), _FAR, np.int64), np.full((queries, k), _FAR, np.int64)

    def search(self, index: Index, names: np.ndarray, codes: np.ndarray, own: np.ndarray) -> None:
        k = self.distance.shape[1]
        distance, found = top_k(index, codes, own, k, self.distance[:, -1])
        ids = np.where(found >= 0, names[found], _FAR)
        distance = np.concatenate([self.distance, np.where(found >= 0, distance, _FAR)], axis=1)
        ids = np.concatenate([self.ids, ids], axis=1)
        order = np.lexsort((ids, distance))[:, :k]
        self.distance, self.ids = np.take_along_axis(distance, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, ident: str = "vec_id", vector: str = "embedding", shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """(vec_id, rank, neighbour_id, distance): the k nearest of all rows by Hamming distance of sign bits, for each query.

    The queries are the rows whose id `every` divides.  Ties go to the lesser id.  A row is no neighbour of itself, but
    rows that repeat an id or a vector are neighbours of each other.  Rows with a null vector or id take no part, nor do
    empty vectors; a null element counts as 0; vectors of several lengths are searched each among those of its length.
    Fewer than k other rows give fewer neighbours.  Extra columns are ignored; an empty table gives an empty result.

    Every task packs its rows into shards as it reads them, without a shuffle, and they are written: as indexes, and
    with the queries taken out as blocks.  A Cartesian product of the two sends every block to every index, so nothing
    is left out.  A task carries a block's k-th distance from index to index; the tasks' best are merged by rank.
    """
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = rows.select("id", "v", F.spark_partition_id().cast("long").alias("p"))

    def pack(batches):
        """Shards of at most `shard` rows of one length, in the order of ids; numbered by partition."""
        held: dict[int, list] = {}
        made = 0

        def close(d):
            nonlocal made
            ids, codes = (np.concatenate(x) for x in zip(*held.pop(d)[1], strict=True))
            order = np.lexsort((*codes.T, ids))
            made += 1
            return _batch(shard=([(part << 24) + made], pa.int64()), d=([d], pa.int32()), n=([len(ids)], pa.int64()), ids=([ids[order].tobytes()], pa.binary()), codes=([codes[order].tobytes()], pa.binary()))

        for batch in batches:
            ids, lists = np.asarray(batch.column(0)), batch.column(1)
            part = batch.column(2)[0].as_py() if batch.num_rows else 0
            size = np.diff(np.asarray(lists.offsets))
            for d in np.unique(size).tolist():
                of = np.flatnonzero(size == d)
                codes = codes_of(lists.take(pa.array(of)).flatten().fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, d))
                for i in range(0, len(of), shard):
                    block = held.setdefault(d, [0, []])
                    block[0] += len(of[i : i + shard])
                    block[1].append((ids[of[i : i + shard]], codes[i : i + shard]))
                    if block[0] >= shard:
                        yield close(d)
        for d in list(held):
            yield close(d)

    shards = written(rows.mapInArrow(pack, "shard bigint, d int, n bigint, ids binary, codes binary"), "indexes")

    def chosen(batches):
        """The queries of shards, several shards' together."""
        held: dict[int, list] = {}

        def close(d):
            own = [np.concatenate(x) for x in zip(*held.pop(d), strict=True)]
            return _batch(q_d=([d], pa.int32()), q_shard=([own[0].tobytes()], pa.binary()), q_at=([own[1].tobytes()], pa.binary()), q_ids=([own[2].tobytes()], pa.binary()), q_codes=([own[3].tobytes()], pa.binary()))

        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                at = np.flatnonzero(ids % every == 0)
                codes = np.frombuffer(r["codes"], np.uint16).reshape(len(ids), -1)
                for i in range(0, len(at), queries):
                    own = at[i : i + queries]
                    block = held.setdefault(r["d"], [])
                    if block and sum(len(b[0]) for b in block) + len(own) > queries:
                        yield close(r["d"])
                        block = held.setdefault(r["d"], [])
                    block.append((np.full(len(own), r["shard"]), own, ids[own], codes[own]))
        for d in list(held):
            yield close(d)

    blocks = written(shards.mapInArrow(chosen, "q_d int, q_shard binary, q_at binary, q_ids binary, q_codes binary"), "queries")

    def search(batches):
        index, best = (None, None, None), {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["d"] != r["q_d"]:
                    continue
                if index[0] != r["shard"]:
                    codes = np.frombuffer(r["codes"], np.uint16)
                    index = r["shard"], Index(codes.reshape(r["n"], -1)), np.frombuffer(r["ids"], np.int64)
                own, at = np.frombuffer(r["q_shard"], np.int64), np.frombuffer(r["q_at"], np.int64)
                key = r["q_shard"], r["q_at"]
                if key not in best:
                    best[key] = Nearest(len(own), k), np.frombuffer(r["q_ids"], np.int64)
                best[key][0].search(index[1], index[2], np.frombuffer(r["q_codes"], np.uint16).reshape(len(own), -1), np.where(own == r["shard"], at, -1))
        for (own, at), (near, ids) in best.items():
            who, rank = np.nonzero(near.ids != _FAR)
            of, at = np.frombuffer(own, np.int64)[who], np.frombuffer(at, np.int64)[who]
            yield _batch(shard=(of, pa.int64()), at=(at, pa.int64()), vec_id=(ids[who], pa.int64()), neighbour_id=(near.ids[who, rank], pa.int64()), distance=(near.distance[who, rank].astype(np.int32), pa.int32()))

    met = shards.crossJoin(blocks)  # lengths are compared in search(): as a join key, one length would be one task
    near = met.mapInArrow(search, "shard bigint, at bigint, vec_id bigint, neighbour_id bigint, distance int")
    order = Window.partitionBy("shard", "at").orderBy("distance", "neighbour_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("vec_id", "rank", "neighbour_id", "distance")


def oracle_sql(k: int = K, every: int = EVERY) -> str:
    """nearest() over embeddings, by comparing every query with every row."""
    return f"""
        WITH c AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, len(embedding) AS d, CAST(list_sum(list_transform(embedding, lambda x, i: CASE WHEN x > 0 THEN CAST(power(2, i - 1) AS HUGEINT) ELSE CAST(0 AS HUGEINT) END)) AS UBIGINT) AS code
            FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
        p AS (SELECT a.r, a.vec_id, b.vec_id AS neighbour_id, CAST(bit_count(xor(a.code, b.code)) AS INTEGER) AS distance FROM c a JOIN c b ON a.r <> b.r AND a.d = b.d WHERE a.vec_id % {every} = 0)
        SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbour_id, distance
        FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY distance, neighbour_id) AS rank FROM p) WHERE rank <= {k}"""
