"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A vector's code has a bit for each number, set if it is not negative. Codes are
cut into segments, each with a table from segment value to codes. A code within
distance d of a query has a segment within d // segments of the query's, so
probing all segments at growing radius finds codes in a known order: once the
k-th verified distance is no larger than what the radii so far must have found,
nothing nearer, nor a tie, can be missing.

Codes are dealt by hash into shards and queries into blocks, both of bounded
size; each pair of a shard and a block is one group with its own tables. Of equal
codes only the k least ids are kept, before the shuffle where it can be.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattshed.llm.common import staged, table

K = 10
EVERY = 20
#: Codes in a shard and queries in a block, about; they bound the memory of a task.
SHARD, BLOCK = 1 << 16, 512


class Tables:
    """Codes of one length with a table for each segment."""

    def __init__(self, bits: np.ndarray):
        n, width = bits.shape
        self.width = width
        self.words = _words(bits)
        # Segments as wide as the logarithm of the number of codes leave about one code to a value.
        count = max(1, round(width / max(1.0, math.log2(max(n, 2)))))
        edges = [width * i // count for i in range(count + 1)]
        self.segments = [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        self.orders, self.starts = [], []
        for a, b in self.segments:
            value = _values(bits[:, a:b])
            self.orders.append(np.argsort(value, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (b - a)))]))
        self.flips: dict[tuple[int, int], np.ndarray] = {}

    def _flip(self, size: int, radius: int) -> np.ndarray:
        """All values of size bits with radius bits set."""
        if (size, radius) not in self.flips:
            picks = np.array(list(combinations(range(size), radius)), dtype=np.int64)
            self.flips[size, radius] = (np.int64(1) << picks).sum(axis=1).reshape(-1)
        return self.flips[size, radius]

    def search(
        self, query: np.ndarray, weights: np.ndarray, k: int, seen: np.ndarray, mark: int, shared: dict[int, list[int]]
    ) -> tuple[np.ndarray, np.ndarray]:
        """(code, distance) of all codes that may hold one of the k nearest ids; ties are whole.

        weights are the ids that each code alone has; shared, by code, those that other
        codes have too. Each of them counts once, at its nearest code.
        """
        nearest: dict[int, int] = {}
        word = _words(query[None, :])[0]
        values = [int(_values(query[None, a:b])[0]) for a, b in self.segments]
        found: list[np.ndarray] = []
        far: list[np.ndarray] = []
        tally = np.zeros(self.width + 1, dtype=np.int64)
        m = len(self.segments)
        kth = self.width
        for radius in range(max(b - a for a, b in self.segments) + 1):
            for j, (a, b) in enumerate(self.segments):
                if radius <= b - a:
                    keys = values[j] ^ self._flip(b - a, radius)
                    lo, hi = self.starts[j][keys], self.starts[j][keys + 1]
                    size = hi - lo
                    at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
                    codes = self.orders[j][at]
                    codes = codes[seen[codes] != mark]
                    seen[codes] = mark
                    distance = np.bitwise_count(self.words[codes] ^ word).sum(axis=1).astype(np.int64)
                    found.append(codes)
                    far.append(distance)
                    np.add.at(tally, distance, weights[codes])
                    for code, d in zip(codes.tolist(), distance.tolist(), strict=True) if shared else ():
                        for one in shared.get(code, ()):
                            if d < nearest.get(one, self.width + 1):
                                if one in nearest:
                                    tally[nearest[one]] -= 1
                                nearest[one] = d
                                tally[d] += 1
                # Codes not found yet differ by more than radius in segments up to j, by radius in the rest.
                covered = m * radius + j
                kth = int(np.searchsorted(np.cumsum(tally), k))
                if kth <= covered:
                    break
            if kth <= covered:
                break
        codes, distance = np.concatenate(found), np.concatenate(far)
        near = distance <= kth
        return codes[near], distance[near]


def _words(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, axis=1)
    padded = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def _values(bits: np.ndarray) -> np.ndarray:
    return bits.astype(np.int64) @ (np.int64(1) << np.arange(bits.shape[1], dtype=np.int64))


def _codes(batches):
    """Sign bits of each vector, packed; vectors that are NULL or hold NULLs have none."""
    for batch in batches:
        vectors = batch.column("vector")
        length = vectors.value_lengths().fill_null(0).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(length)])
        flat = vectors.flatten()
        gaps = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
        whole = (length > 0) & (gaps[offsets[1:]] == gaps[offsets[:-1]])
        signs = flat.fill_null(0).to_numpy() >= 0
        codes = [np.packbits(signs[a:b]).tobytes() if w else None for a, b, w in zip(offsets, offsets[1:], whole, strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(length.astype(np.int32)), pa.array(codes, pa.binary())], ["id", "width", "code"]
        )


def _bits(codes: pa.Array, width: int) -> np.ndarray:
    packed = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    return np.unpackbits(packed, axis=1, count=width).astype(bool)


def _search(k: int):
    def pair(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            width = rows.column("width")[0].as_py()
            codes = rows.column("code").combine_chunks().dictionary_encode()
            which = codes.indices.to_numpy()
            ids = rows.column("id").to_numpy()
            order = np.lexsort((ids, which))
            which, ids = which[order], ids[order]
            weights = np.bincount(which)
            begin = np.cumsum(weights) - weights
            _, place, count = np.unique(ids, return_inverse=True, return_counts=True)
            several = count[place] > 1
            alone = np.bincount(which[~several], minlength=len(weights))
            shared: dict[int, list[int]] = {}
            for code, one in zip(which[several].tolist(), ids[several].tolist(), strict=True):
                shared.setdefault(code, []).append(one)
            tables = Tables(_bits(codes.dictionary, width))
            seen = np.full(len(weights), -1, dtype=np.int64)
            asked = _bits(queries.column("code").combine_chunks(), width)
            for i, query_id in enumerate(queries.column("id").to_pylist()):
                near, distance = tables.search(asked[i], alone, k, seen, i, shared)
                size = weights[near]
                at = np.repeat(begin[near] - np.cumsum(size) + size, size) + np.arange(size.sum())
                far, them = np.repeat(distance, size), ids[at]
                best = np.lexsort((them, far))
                if shared:  # an id with several codes is found by its nearest
                    best = best[np.sort(np.unique(them[best], return_index=True)[1])]
                best = best[:k]
                out[0] += [query_id] * len(best)
                out[1] += them[best].tolist()
                out[2] += far[best].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], ["query_id", "id", "distance"])

    return pair


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, distance): the k nearest rows of each query, itself included.

    By Hamming distance of the sign bits, then vec_id. A vector only meets those
    of its own length. Rows without id, without vector or with NULLs in it are
    neither found nor asked for; rows that repeat an id and a code count once; an
    id with several codes is found by its nearest.
    """

    def coded(df: DataFrame) -> DataFrame:
        own = df.select(df[vec_id].cast("long").alias("id"), df[embedding].alias("vector")).where("id is not null")
        return own.mapInArrow(_codes, "id bigint, width int, code binary").where("code is not null")

    least = Window.partitionBy("width", "code").orderBy("id")
    index = staged(
        coded(vectors).distinct().withColumn("turn", F.row_number().over(least)).where(F.col("turn") <= k).drop("turn"),
        "codes",
    )
    asked = staged(coded(queries).distinct(), "queries")
    shards = max(1, math.ceil(index.count() / shard))
    blocks = max(1, math.ceil(asked.count() / block))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = index.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int")).withColumn("block", spread(blocks))
    them = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(shards))
    keys = ["width", "shard", "block"]
    found = (
        rows.groupBy(*keys)
        .cogroup(them.groupBy(*keys))
        .applyInArrow(_search(k), "query_id bigint, id bigint, distance int")
        .groupBy("query_id", "id")
        .agg(F.min("distance").alias("distance"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "distance")
    )


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP4_SQL = f"""
WITH bits AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x >= 0) AS code FROM embeddings WHERE vec_id IS NOT NULL
), met AS (
    SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
        min(len(list_filter(range(1, len(q.code) + 1), lambda i: q.code[i] <> r.code[i]))) AS distance
    FROM bits q JOIN bits r ON len(q.code) = len(r.code)
    WHERE q.vec_id % {EVERY} = 0
    GROUP BY 1, 2
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM met)
WHERE rank <= {K}
"""
