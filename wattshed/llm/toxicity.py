"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicons (terms that stand out in toxic texts of a bounded sample of
labelled rows, dealt into many lists) and patterns. Most of them abstain on most
texts, some are bad, some repeat each other. The label model takes the true label
as hidden and estimates by expectation maximisation how often each voter fires in
either class, and how voters go together within a class; their joint covariance
discounts voters that say the same thing. Its posterior labels, not the given
ones, train a sparse linear classifier on hashed terms, which then scores every
text. Only the sample meets the driver; texts are scored where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattshed.llm.common import first_by_hash, free_name, table, with_struct
from wattshed.llm.features import UPPER, per_text
from wattshed.llm.words import FOLD, chunks, mix, span_hashes, windows, words_of

#: Labelled rows that the voters and the classifier are made from, at most.
SAMPLE = 12_000
#: Terms are hashed to so many slots.
SLOT_BITS = 20
#: Bytes of the beginnings of words that are terms too, beside whole words.
PREFIXES = (4, 5, 6)
#: Lexicons of different terms, and texts that a term must be found in.
LEXICONS, LEAST_TEXTS = 24, 4
#: Correlation of voters that is taken for chance.
NOISE = 0.05
#: Score from which a text is predicted toxic.
TOXIC_FROM = 0.7

BETWEEN = np.ones(256, dtype=bool)
BETWEEN[ord("0") : ord("9") + 1] = False
BETWEEN[ord("A") : ord("Z") + 1] = False
BETWEEN[ord("a") : ord("z") + 1] = False
BETWEEN[0x80:] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of all words of a chunk and of their beginnings, repeats included."""
    words = words_of(data, offsets, BETWEEN)
    folded = FOLD[data]
    owners, slots = [], []
    for k, size in enumerate((1 << 30, *PREFIXES)):
        longer = words.end - words.start > size if k else np.ones(len(words.start), dtype=bool)
        start, end = words.start[longer], np.minimum(words.end, words.start + size)[longer]
        hashes = mix(span_hashes(folded, start, end) + np.uint64(k))
        owners.append(words.owner[longer])
        slots.append((hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(slots)


def patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of each text by pattern voters: shouting, capitals, digits in words, long runs of a letter."""
    n_bytes = np.maximum(np.diff(offsets), 1)
    exclaims = per_text(data == ord("!"), offsets)
    capitals = per_text(UPPER[data], offsets)
    same = np.zeros(len(data), dtype=bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & ~BETWEEN[data[2:]]
    asterisks = per_text(data == ord("*"), offsets)
    return np.stack(
        [exclaims * 100 > n_bytes, capitals * 5 > n_bytes, per_text(same, offsets) > 0, asterisks > 0, exclaims > 2], axis=1
    )


@dataclass
class LabelModel:
    """Posterior of the hidden label from votes (texts by voters, 1 where a voter fires)."""

    prior: float
    weights: np.ndarray
    bias: float
    rates: np.ndarray  # how often each voter fires: (class, voter)
    correlations: np.ndarray  # of voters within a class

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes @ self.weights + self.bias, -30, 30)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
    """By expectation maximisation, from a first guess of each label's probability.

    A voter's log odds count for less the more it goes along with others within a
    class: of several that always fire together, all together count as one.
    """
    votes = votes.astype(np.float64)
    n, m = votes.shape
    p = start.astype(np.float64)
    model = None
    for _ in range(rounds):
        mass = np.array([(1 - p).sum(), p.sum()])
        rates = (np.stack([(1 - p) @ votes, p @ votes]) + 0.5) / (mass[:, None] + 1)
        rest0, rest1 = votes - rates[0], votes - rates[1]
        cov = ((rest0 * (1 - p)[:, None]).T @ rest0 + (rest1 * p[:, None]).T @ rest1) / n
        spread = np.sqrt(np.diag(cov) + 1e-9)
        together = cov / np.outer(spread, spread)
        share = 1 / (1 + np.clip(together - np.eye(m) - NOISE, 0, None).sum(axis=1))
        prior = float(np.clip(mass[1] / n, 0.001, 0.999))
        absent = np.log((1 - rates[1]) / (1 - rates[0]))
        weights = share * (np.log(rates[1] / rates[0]) - absent)
        bias = float((share * absent).sum()) + float(np.log(prior / (1 - prior)))
        model = LabelModel(prior, weights, bias, rates, together)
        p = model.posterior(votes)
    return model


@dataclass
class Rows:
    """Sparse rows of slots."""

    owner: np.ndarray
    slot: np.ndarray
    n: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.slot], minlength=self.n)

    def back(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slot, weights=values[self.owner], minlength=size)


def near_copy_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two minima of hashed five-word windows of each text; near copies share one as a rule."""
    words = words_of(data, offsets)
    at, hashes = windows(words, words.hashes(folded=True), 5)
    keys = np.full((len(offsets) - 1, 2), np.iinfo(np.int64).max)
    for k in range(2):
        np.minimum.at(keys[:, k], words.owner[at], (mix(hashes ^ np.uint64(k)) >> np.uint64(1)).astype(np.int64))
    return keys


def distinct_rows(keys: np.ndarray) -> np.ndarray:
    """Numbers of rows that share neither key with a row before. Copies would lend weight to
    words that mean nothing. Texts without a window, with the largest number as key, stay."""
    keep = np.ones(len(keys), dtype=bool)
    for column in keys.T:
        first = np.zeros(len(keys), dtype=bool)
        first[np.unique(column, return_index=True)[1]] = True
        keep &= first | (column == np.iinfo(np.int64).max)
    return np.flatnonzero(keep)


def chosen(rows: Rows, which: np.ndarray) -> Rows:
    number = np.full(rows.n, -1)
    number[which] = np.arange(len(which))
    kept = number[rows.owner] >= 0
    return Rows(number[rows.owner[kept]], rows.slot[kept], len(which))


def find_terms(rows: Rows, labels: np.ndarray) -> np.ndarray:
    """Slots that stand out in texts labelled 1, strongest first."""
    size = 1 << SLOT_BITS
    every = np.bincount(rows.slot, minlength=size)
    toxic = rows.back(labels.astype(float), size)
    base = labels.mean() if len(labels) else 0.0
    expected = every * base
    z = (toxic - expected) / np.sqrt(expected * (1 - base) + 1)
    found = np.flatnonzero((every >= LEAST_TEXTS) & (toxic > 0.9 * every) & (z > 4))
    return found[np.argsort(-z[found], kind="stable")]


def telling(rows: Rows, target: np.ndarray) -> np.ndarray:
    """Flags of slots that go with the posterior labels, for or against, beyond chance."""
    size = 1 << SLOT_BITS
    every = np.bincount(rows.slot, minlength=size)
    expected = every * target.mean()
    z = (rows.back(target, size) - expected) / np.sqrt(expected * (1 - target.mean()) + 1)
    return (every >= LEAST_TEXTS) & (np.abs(z) > 3)


def lexicons(found: np.ndarray) -> list[np.ndarray]:
    """The terms dealt to LEXICONS lists, and lists of the strongest that overlap them."""
    lists = [found[i::LEXICONS] for i in range(LEXICONS)]
    lists += [found[: max(1, len(found) // k)] for k in (1, 2, 4, 8)]
    return [x for x in lists if len(x)]


def lexicon_votes(rows: Rows, lists: list[np.ndarray]) -> np.ndarray:
    votes = np.zeros((rows.n, len(lists)), dtype=bool)
    for j, members in enumerate(lists):
        member = np.zeros(1 << SLOT_BITS, dtype=bool)
        member[members] = True
        votes[rows.owner[member[rows.slot]], j] = True
    return votes


def fit_linear(rows: Rows, target: np.ndarray, rounds: int = 300, penalty: float = 5e-5) -> tuple[np.ndarray, float]:
    """Weights of slots and a bias: logistic loss with soft labels and an absolute penalty.

    Both classes weigh the same. Accelerated proximal gradient steps.
    """
    size = 1 << SLOT_BITS
    share = np.clip(target.mean() if len(target) else 0.5, 0.02, 0.98)
    weight = (target * 0.5 / share + (1 - target) * 0.5 / (1 - share)) / max(rows.n, 1)
    if not rows.n:
        return np.zeros(size, dtype=np.float32), -2.0
    # A bound of the curvature by power iteration.
    v = np.ones(size)
    top = 1.0
    for _ in range(8):
        v = rows.back(weight * 0.25 * rows.times(v), size).astype(np.float64)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    step = 1 / (1.2 * top + 0.25)
    w = z = np.zeros(size)
    bias = zb = 0.0
    t = 1.0
    for _ in range(rounds):
        error = weight * (1 / (1 + np.exp(-np.clip(rows.times(z) + zb, -30, 30))) - target)
        new = z - step * rows.back(error, size)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        nb = zb - step * float(error.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - bias)
        w, bias, t = new, nb, nt
    return w.astype(np.float32), bias


def _sampled(batches):
    """Distinct slots and pattern flags of each text."""
    for batch in batches:
        slots_out, flags_out, keys_out = [], [], []
        for lo, hi, data, offsets in chunks(batch.column("text")):
            owner, slot = terms(data, offsets)
            key = np.unique((owner << SLOT_BITS) | slot)
            edges = np.searchsorted(key >> SLOT_BITS, np.arange(hi - lo + 1)).astype(np.int32)
            slots = pa.array((key & ((1 << SLOT_BITS) - 1)).astype(np.int32))
            slots_out.append(pa.ListArray.from_arrays(pa.array(edges), slots))
            flags_out += patterns(data, offsets).tolist()
            keys_out += near_copy_keys(data, offsets).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                pa.concat_arrays(slots_out) if slots_out else pa.array([], pa.list_(pa.int32())),
                pa.array(flags_out, pa.list_(pa.bool_())),
                pa.array(keys_out, pa.list_(pa.int64())),
            ],
            ["doc_id", "label", "slots", "flags", "keys"],
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, LabelModel | None]:
    """Weights and bias of the classifier, and the label model, from at most sample labelled rows.

    docs has doc_id and text, labels doc_id and label; the rows that come first by
    the hash of doc_id are taken, and joined as a broadcast of at most sample rows.
    """
    taken = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    taken = first_by_hash(taken, sample, "doc_id")
    met = docs.join(F.broadcast(taken), "doc_id").where("text is not null").select("doc_id", "text", "label")
    got = met.mapInArrow(_sampled, "doc_id bigint, label int, slots array<int>, flags array<boolean>, keys array<bigint>")
    got = got.toArrow()
    got = got.sort_by("doc_id")
    if not got.num_rows:
        return np.zeros(1 << SLOT_BITS, dtype=np.float32), -2.0, None
    lists = got.column("slots").combine_chunks()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    slots = lists.flatten().to_numpy().astype(np.int64)
    rows = Rows(np.repeat(np.arange(got.num_rows), sizes), slots, got.num_rows)
    alone = distinct_rows(np.array(got.column("keys").to_pylist(), dtype=np.int64).reshape(-1, 2))
    rows = chosen(rows, alone)
    given = got.column("label").to_numpy()[alone]
    found = find_terms(rows, given)
    if not len(found) or given.all():
        return np.zeros(1 << SLOT_BITS, dtype=np.float32), -2.0, None
    flags = np.array(got.column("flags").to_pylist(), dtype=bool)[alone]
    votes = np.concatenate([lexicon_votes(rows, lexicons(found)), flags], axis=1)
    # A first guess: the share of lexicons that fire, sharpened.
    start = np.where(votes[:, : -flags.shape[1]].any(axis=1), 0.9, 0.02)
    model = fit_label_model(votes, start)
    target = model.posterior(votes)
    kept = telling(rows, target)[rows.slot]
    weights, bias = fit_linear(Rows(rows.owner[kept], rows.slot[kept], rows.n), target)
    return weights, bias, model


_SCORE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def scored(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text") -> tuple[DataFrame, str]:
    """docs with a struct more, and its name: score and predicted, of each whole text.

    NULL and empty texts have no terms and score by the bias alone. Each row is
    scored for itself. Columns of docs keep their names: the struct takes a free one.
    """
    used = np.flatnonzero(weights)
    values = weights[used].astype(np.float64)
    where = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
    where[used] = np.arange(len(used))

    def make(batch: pa.RecordBatch) -> pa.Array:
        out = []
        for lo, hi, data, offsets in chunks(batch.column(text)):
            owner, slot = terms(data, offsets)
            at = where[slot]
            key = np.unique(owner[at >= 0] * np.int64(len(used) + 1) + at[at >= 0])
            total = np.bincount(key // (len(used) + 1), weights=values[key % (len(used) + 1)], minlength=hi - lo)
            out.append(1 / (1 + np.exp(-np.clip(total + bias, -30, 30))))
        score = np.concatenate(out) if out else np.zeros(0)
        return pa.StructArray.from_arrays(
            [pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32))], ["score", "predicted"]
        )

    name = free_name(docs, "toxicity")
    return with_struct(docs, name, _SCORE, make), name


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    weights, bias, _ = train(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("label")))
    rows, name = scored(docs, weights, bias)
    return rows.select("doc_id", held_out().alias("held_out"), f"{name}.score", f"{name}.predicted")
