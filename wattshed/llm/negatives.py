"""Hard negatives by exact search over rotated one-bit codes.

Vectors are taken as integers, floor(scale * x). The index turns each by a fixed
random rotation and keeps the signs (one bit a number), the length of the vector
and its alignment with the code, the inner product with the unit vector that the
signs stand for. A vector is its alignment times that unit vector and a residual
at right angles to it, so for a query

    score = alignment * <query, code> + <residual, query>,

where by Cauchy and Schwarz the last term is no larger than the residual's length
times the length of what the code leaves of the query. <query, code> comes from
bit counts of the code under the planes of the query, whose own rounding widens the
interval by a bound of its own. Only rows whose interval reaches the range asked
for are scored, in integers, so nothing is lost.

Rows stay where they are. Anchors are sent to them in blocks of bounded size, and
the rows of one block's search come in rounds, each about STEP times as many as all
before: a first round of some thousands, which one task takes. The k-th best so far
goes along with the block, so that about k * STEP rows for each anchor come back
from each round, however many tasks there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattshed.llm.common import staged, table
from wattshed.session import scratch_folder

SCALE = 256
POSITIVES = NEGATIVES = 5
LEAST_PERCENT = 80
ANCHOR_EVERY = 100
#: Anchors in a block, about; they bound what is sent to each executor and to the driver.
BLOCK = 8192
#: Rows of the first round, about, and how much larger each next one is.
FIRST, STEP, LEVELS = 1024, 8, 12
#: Bits of a query's numbers, as planes.
PLANES = 6
#: Pairs of an anchor and a row that a task looks at together.
PAIRS = 1 << 19
#: Larger numbers would not leave room for a score in 64 bits.
LARGEST = 1 << 26

_INDEX = (
    "vec_id bigint, label bigint, anchor boolean, level int, width int, ints array<int>,"
    " code binary, length double, alignment double"
)
_FOUND = "at int, turn int, anchor_id bigint, positive_id bigint, positive_score bigint, score bigint, vec_id bigint"


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits of each row as 64-bit words, from the left, filled up with zeros."""
    width = bits.shape[-1]
    packed = np.packbits(bits, axis=-1)
    padded = np.zeros((*packed.shape[:-1], -(-width // 64) * 8), dtype=np.uint8)
    padded[..., : packed.shape[-1]] = packed
    return padded.view(np.uint64)


def _coded(scale: int):
    def each(batches):
        for batch in batches:
            vectors = batch.column("vector")
            width = vectors.value_lengths().fill_null(0).to_numpy()
            begin = np.cumsum(width) - width
            flat = vectors.flatten()
            numbers = np.floor(scale * flat.fill_null(math.nan).to_numpy().astype(np.float64))
            with np.errstate(invalid="ignore"):
                bad = np.concatenate([[0], np.cumsum(~(np.abs(numbers) <= LARGEST))])
            whole = (width > 0) & (bad[begin + width] == bad[begin])
            for w in np.unique(width[whole]).tolist():
                rows = np.flatnonzero(whole & (width == w))
                ints = numbers[begin[rows][:, None] + np.arange(w)]
                turned = ints @ rotation(w)
                code = _words(turned >= 0).view(np.uint8).reshape(len(rows), -1)
                pick = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(pick) for c in ("vec_id", "label", "anchor", "level")),
                        pa.array(np.full(len(rows), w, dtype=np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * w), pa.array(ints.astype(np.int32).ravel())),
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(np.sqrt((ints * ints).sum(axis=1))),
                        pa.array(np.abs(turned).sum(axis=1) / math.sqrt(w)),
                    ],
                    [c.split()[0] for c in _INDEX.split(", ")],
                )

    return each


@dataclass
class Rows:
    """Vectors of one width with their codes."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray
    words: np.ndarray
    ones: np.ndarray
    length: np.ndarray
    alignment: np.ndarray
    residual: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table) -> Rows:
        width = batch.column("width")[0].as_py()
        n = batch.num_rows
        column = lambda c: batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c)
        words = np.frombuffer(b"".join(column("code").to_pylist()), dtype=np.uint64).reshape(n, -1)
        length, alignment = column("length").to_numpy(), column("alignment").to_numpy()
        return cls(
            column("vec_id").to_numpy(), column("label").to_numpy(),
            column("ints").flatten().to_numpy().astype(np.int64).reshape(n, width), words,
            np.bitwise_count(words).sum(axis=1, dtype=np.int32), length, alignment,
            np.sqrt(np.maximum(length * length - alignment * alignment, 0)),
        )

    def take(self, at) -> Rows:
        return Rows(*(getattr(self, f)[at] for f in self.__dataclass_fields__))


@dataclass
class Queries:
    """Anchors of one width: places in the block, vectors, and their bit planes."""

    at: np.ndarray
    rows: Rows
    planes: np.ndarray = field(init=False)
    low: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)
    total: np.ndarray = field(init=False)
    square: np.ndarray = field(init=False)
    rounding: np.ndarray = field(init=False)

    def __post_init__(self):
        turned = self.rows.ints.astype(np.float64) @ rotation(self.rows.ints.shape[1])
        top = (1 << PLANES) - 1
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-9) / top
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.planes = np.stack([_words((level >> p & 1).astype(bool)) for p in range(PLANES)])
        self.total = rounded.sum(axis=1)
        self.square = (rounded * rounded).sum(axis=1)
        self.rounding = np.sqrt(((turned - rounded) ** 2).sum(axis=1))

    def intervals(self, mine: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that each row can have with the anchors mine."""
        width = rows.ints.shape[1]
        under = np.zeros((len(mine), len(rows.ids)), dtype=np.int32)
        for p in range(PLANES):
            for w in range(rows.words.shape[1]):
                under += np.bitwise_count(self.planes[p, mine, w][:, None] & rows.words[None, :, w]).astype(np.int32) << p
        along = self.low[mine, None] * rows.ones + self.step[mine, None] * under
        along = (2 * along - self.total[mine, None]) / math.sqrt(width)
        rest = np.sqrt(np.maximum(self.square[mine, None] - along * along, 0))
        reach = rows.residual * rest + rows.length * self.rounding[mine, None]
        # Room for the rounding of all these doubles.
        reach += 1 + 1e-9 * rows.length * self.rows.length[mine, None]
        middle = rows.alignment * along
        return middle - reach, middle + reach

    def scores(self, mine: np.ndarray, rows: Rows, which: np.ndarray) -> np.ndarray:
        """Integer inner products of pairs of an anchor and a row."""
        out = np.empty(len(mine), dtype=np.int64)
        many = max(1, PAIRS // max(1, rows.ints.shape[1] // 16))
        for lo in range(0, len(mine), many):
            pair = slice(lo, lo + many)
            out[pair] = np.einsum("ij,ij->i", self.rows.ints[mine[pair]], rows.ints[which[pair]])
        return out


def best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k first of each key, by falling score, then id."""
    order = np.lexsort((ids, -score, key))
    sorted_keys = key[order]
    first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


@dataclass
class Block:
    """Anchors, and for each and each turn the range of scores asked for and the k-th best so far.

    Searching positives there is one turn, above all scores; searching negatives
    there is one for each positive.
    """

    queries: list[Queries]
    ids: np.ndarray
    alike: bool
    k: int
    low: np.ndarray
    high: np.ndarray
    positive: np.ndarray
    kth_score: np.ndarray
    kth_id: np.ndarray

    def fits(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which pairs are in range and no worse than the k-th best."""
        low, high = self.low.ravel()[key], self.high.ravel()[key]
        score_k, id_k = self.kth_score.ravel()[key], self.kth_id.ravel()[key]
        return (score >= low) & (score <= high) & ((score > score_k) | (score == score_k) & (ids <= id_k))


_NONE = np.iinfo(np.int64).min


class Found:
    """The best rows of a task so far, for each anchor and turn."""

    def __init__(self, block: Block):
        self.block = block
        self.score_k = block.kth_score.copy()
        self.key = np.zeros(0, dtype=np.int64)
        self.score, self.ids = self.key, self.key

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        turns = self.block.low.shape[1]
        key = (at[:, None] * turns + np.arange(turns)).ravel()
        score, ids = np.repeat(score, turns), np.repeat(ids, turns)
        fit = self.block.fits(key, score, ids) & (score >= self.score_k.ravel()[key])
        if not fit.any():
            return
        key = np.concatenate([self.key, key[fit]])
        score, ids = np.concatenate([self.score, score[fit]]), np.concatenate([self.ids, ids[fit]])
        keep = best(key, score, ids, self.block.k)
        self.key, self.score, self.ids = key[keep], score[keep], ids[keep]
        last = np.flatnonzero(np.append(self.key[1:] != self.key[:-1], True))
        full = last[np.diff(np.append(-1, last)) == self.block.k]
        kth = self.score_k.ravel()
        kth[self.key[full]] = np.maximum(kth[self.key[full]], self.score[full])
        self.score_k = kth.reshape(self.score_k.shape)

    def floor(self) -> np.ndarray:
        """The least score that still helps each anchor, in any turn that asks for something."""
        wanted = np.maximum(self.block.low, self.score_k)
        return np.where(self.block.low <= self.block.high, wanted, np.iinfo(np.int64).max).min(axis=1)

    def look(self, queries: Queries, mine: np.ndarray, rows: Rows, alike: bool) -> None:
        """Compares the anchors mine with rows; alike if all have one label."""
        at = queries.at[mine]
        low, high = queries.intervals(mine, rows)
        floor = self.floor()[at].astype(np.float64)
        other = rows.ids != queries.rows.ids[mine, None]
        if alike and len(rows.ids) >= self.block.k:
            sure = np.where(other, low, -np.inf)
            floor = np.maximum(floor, np.partition(sure, -self.block.k, axis=1)[:, -self.block.k])
        ceiling = self.block.high[at].max(axis=1).astype(np.float64)
        may = other & (high >= floor[:, None]) & (low <= ceiling[:, None])
        if not alike:
            may &= rows.labels != queries.rows.labels[mine, None]
        a, b = np.nonzero(may)
        self.add(at[a], queries.scores(mine[a], rows, b), rows.ids[b])

    def batches(self):
        order = np.argsort(self.key, kind="stable")
        turns = self.block.low.shape[1]
        for lo in range(0, len(order), 20_000):
            pick = order[lo : lo + 20_000]
            at, turn = np.divmod(self.key[pick], turns)
            positive = self.block.positive.reshape(-1, 2)[self.key[pick]]
            columns = [at.astype(np.int32), turn.astype(np.int32), self.block.ids[at], positive[:, 0], positive[:, 1], self.score[pick], self.ids[pick]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])


def _search(shared):
    def each(batches):
        block: Block = shared.value
        found = Found(block)
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for queries in block.queries:
                own = np.flatnonzero(widths == queries.rows.ints.shape[1])
                if not len(own):
                    continue
                rows = Rows.of(batch.take(pa.array(own)))
                if block.alike:
                    groups = [(np.flatnonzero(queries.rows.labels == x), np.flatnonzero(rows.labels == x)) for x in np.unique(rows.labels)]
                else:
                    groups = [(np.arange(len(queries.at)), np.arange(len(own)))]
                for mine, them in groups:
                    for lo in range(0, len(them) if len(mine) else 0, 2048):
                        some = rows.take(them[lo : lo + 2048])
                        many = max(1, PAIRS // len(some.ids))
                        for a in range(0, len(mine), many):
                            found.look(queries, mine[a : a + many], some, block.alike)
        yield from found.batches()

    return each


def _first(df: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and turn, numbered from 1 as rank."""
    order = Window.partitionBy("at", "turn").orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Index:
    """Codes of all rows, in levels of hash: level L holds about one row in STEP**L."""

    def __init__(self, vectors: DataFrame, anchor: Column, vec_id: str, embedding: str, label: str, scale: int):
        self.spark = vectors.sparkSession
        own = vectors.select(
            vectors[vec_id].cast("long").alias("vec_id"), vectors[label].cast("long").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"), vectors[embedding].cast("array<double>").alias("vector"),
        ).where("vec_id is not null and label is not null and vector is not null").distinct()
        part = (F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(1 << 40)) + 1) / float(1 << 40)
        level = F.least(F.lit(LEVELS), F.floor(-F.log(part) / math.log(STEP))).cast("int")
        self.path = scratch_folder(self.spark, "one-bit-codes")
        coded = own.withColumn("level", level).mapInArrow(_coded(scale), _INDEX)
        coded.write.partitionBy("level").parquet(self.path)
        names = [c.split()[0] for c in _INDEX.split(", ")]
        self.rows = self.spark.read.schema(coded.schema).parquet(self.path).select(*names)
        counts = {r["level"]: r["count"] for r in self.rows.groupBy("level").count().collect()}
        self.rounds, top, size = [], LEVELS, 0
        for low in range(LEVELS, -1, -1):
            size += counts.get(low, 0)
            if size >= FIRST or (low == 0 and size):
                self.rounds.append((low, top))
                top, size = low - 1, FIRST  # from here on each level is a round

    def search(self, block: Block) -> DataFrame:
        """The block's k best of each anchor and turn."""
        held: DataFrame | None = None
        for low, top in self.rounds:
            rows = self.rows.where(F.col("level").between(low, top))
            if held is None:
                rows = rows.coalesce(1)
            shared = self.spark.sparkContext.broadcast(block)
            found = rows.mapInArrow(_search(shared), _FOUND)
            held = staged(_first(found if held is None else held.drop("rank").unionByName(found), block.k), "best-so-far")
            shared.unpersist()
            last = held.where(F.col("rank") == block.k).select("at", "turn", "score", "vec_id").toArrow()
            at, turn = last["at"].to_numpy(), last["turn"].to_numpy()
            block.kth_score[at, turn], block.kth_id[at, turn] = last["score"].to_numpy(), last["vec_id"].to_numpy()
        return held


def _block(queries: list[Queries], ids: np.ndarray, low: np.ndarray, high: np.ndarray, positive: np.ndarray, alike: bool, k: int) -> Block:
    return Block(queries, ids, alike, k, low, high, positive, np.full(low.shape, _NONE), np.full(low.shape, np.iinfo(np.int64).max))


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where anchor holds.

    An anchor's positives are its best other rows of one label, a positive's
    negatives the best rows of other labels that score at least least_percent of it
    and no more than it; best is the higher score, then the smaller vec_id. Scores
    are inner products of floor(scale * x). Only vectors of one length meet. Rows
    with a NULL id, label or vector, an empty vector, or a number that is NULL, not
    finite or beyond LARGEST take no part. Repeated rows count once; rows that share
    an id but not all else count each, and are never each other's positives or
    negatives. Tables without rows or anchors give none.
    """
    spark = vectors.sparkSession
    index = Index(vectors, anchor, vec_id, embedding, label, scale)
    asked = staged(index.rows.where("anchor"), "anchors")
    blocks = math.ceil(asked.count() / block)
    out = scratch_folder(spark, "hard-negatives")
    schema = None
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("vec_id", "label", "code"), F.lit(blocks)) == number
        rows = asked.where(mine).orderBy("width", "vec_id").toArrow()
        if not rows.num_rows:
            continue
        widths, ids = rows["width"].to_numpy(), rows["vec_id"].to_numpy()
        queries = [Queries(np.flatnonzero(widths == w), Rows.of(rows.take(np.flatnonzero(widths == w)))) for w in np.unique(widths)]
        shape = (len(ids), 1)
        nothing = np.zeros((*shape, 2), dtype=np.int64)
        top = np.iinfo(np.int64).max
        near = index.search(_block(queries, ids, np.full(shape, _NONE), np.full(shape, top), nothing, True, positives)).toArrow()
        at, turn = near["at"].to_numpy(), near["rank"].to_numpy() - 1
        positive = np.zeros((len(ids), positives, 2), dtype=np.int64)
        positive[at, turn, 0], positive[at, turn, 1] = near["vec_id"].to_numpy(), near["score"].to_numpy()
        low, high = np.full((len(ids), positives), top), np.full((len(ids), positives), _NONE)
        score = near["score"].to_numpy()
        low[at, turn], high[at, turn] = -(-least_percent * score // 100), score
        found = index.search(_block(queries, ids, low, high, positive, False, negatives))
        result = found.select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        schema = result.schema
        result.write.parquet(f"{out}/block={number}")
    if schema is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)


OP11_SQL = f"""
WITH own AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), met AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM own a JOIN own b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE a.vec_id % {ANCHOR_EVERY} = 0
), near AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM met WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), hard AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM near JOIN met USING (anchor_id)
    WHERE NOT alike AND {LEAST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM hard WHERE rank <= {NEGATIVES}
"""
