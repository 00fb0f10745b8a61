"""Join of documents whose word shingles overlap: Jaccard similarity of a share or more.

Two sets of n and m shingles link when they have needed(n, m) in common. Small
and large sets are treated apart, with the boundary that costs least:

* A small set sends the fixed-size subsets of as many shingles as a partner of
  each size would have to share. Two sets that meet in a subset are linked by
  that alone, so each goes to the least partner and no pairs are listed.
* A large set sends only a prefix of its shingles to inverted lists, long enough
  that linked sets must meet there. Shingles found in very many texts come last
  in the order, so boilerplate seldom reaches a prefix.

Lists are scanned in steps, since a group of near copies shares whole lists. First
each list links its texts to its least one; then, in long lists that still hold
several components, to neighbours in a few random orders; what is left, pairs
from different components that share a list, is enumerated whole. A link between
two texts of one component changes nothing and need not be tested. Every pair
tested is counted exactly from the two texts, after sketches of the sets have ruled
out those that differ by too much.

Exact copies (equal sets) are classes, of which one text stands for all.

That finds the components but not all links. Linked texts are always of one
component, so link_counts() takes the classes of each component once more, cuts
them into parts of bounded size, and counts the shingles of all pairs of texts
of two parts as products of their incidence matrices. No pair becomes a row.
"""

from __future__ import annotations

import itertools
import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattshed.llm.common import free_name, staged, table
from wattshed.llm.components import components
from wattshed.llm.features import keyed
from wattshed.llm.words import CHUNK, WORDS, blocks, chunks, mix, words_of

SHINGLE = 5
#: Similarity of SHARE out of OUT_OF or more.
SHARE, OUT_OF = 75, 100
#: Bytes of text among which a task settles copies and finds frequent shingles.
BLOCK = 4 << 20
#: Shingles of different sets among which a task finds those that several sets hold.
HELD = 1 << 22
#: A shingle is heavy if one of so many texts holds it, so heavy ones are at most
#: this many times the mean set size, whatever the size of the corpus.
HEAVY_ONE_IN = 16_000
HEAVY_LEAST = 16
#: What a posting in an inverted list costs, counted in subsets of a small set.
LIST_COST = 8
LARGEST_SMALL = 16
#: Rows of an Arrow batch of texts or pairs of texts; bounds what a worker holds beside its slices.
BATCH_ROWS = 1000
#: Buckets of doc_ids by which texts that no pair needs are left out; bounds a broadcast.
BUCKETS = 1 << 18
#: Least bits of the sketch of a set; larger sets have a power of two, twice their size or more.
SKETCH = 512
#: Random orders in which long lists are linked, and what is long.
ORDERS, LONG = 8, 16
#: Classes and shingles in a part of a component, about; two parts are one task's memory.
PART_TEXTS, PART_SHINGLES = 512, 1 << 17
#: Factor between the bands of sizes of a component; linked sets are of one band or of neighbours.
BAND = 1.005 * OUT_OF / SHARE
#: Shingles in a slice of an incidence matrix.
COLUMNS = 4096


def needed(n: int, m: int) -> int:
    """Shingles that linked sets of n and m have in common at least."""
    return -(-SHARE * (n + m) // (OUT_OF + SHARE))


def needed_column(n: Column, m: Column) -> Column:
    return F.ceil(SHARE * (n + m) / F.lit(OUT_OF + SHARE)).cast("long")


def prefix(n):
    """Length of the prefix in which linked sets meet, for any partner."""
    return n - -(-SHARE * n // OUT_OF) + 1


def prefix_column(n: Column) -> Column:
    return n - F.ceil(SHARE * n / F.lit(OUT_OF)).cast("long") + 1


def partners(n: int) -> range:
    return range(-(-SHARE * n // OUT_OF), OUT_OF * n // SHARE + 1)


def subset_count(n: int) -> int:
    return sum(math.comb(n, needed(n, m)) for m in partners(n) if needed(n, m) <= n)


def boundary(sizes: dict[int, int], list_cost: int = LIST_COST) -> int:
    """Largest small size at which subsets and lists cost least together.

    sizes has the number of sets of each size up to LARGEST_SMALL times 4/3. Small
    sets near the boundary go to the lists too, for their larger partners.
    """

    def cost(x: int) -> int:
        subsets = sum(c * subset_count(n) for n, c in sizes.items() if n <= x)
        lists = sum(c * prefix(n) * list_cost for n, c in sizes.items() if n >= min(partners(x + 1)))
        return subsets + lists

    return min(range(LARGEST_SMALL + 1), key=lambda x: (cost(x), x))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of a chunk, sorted, and the size of each set."""
    words = words_of(data, offsets)
    values = words.hashes(folded=True)
    n_words = np.diff(words.first)
    length = np.minimum(n_words, SHINGLE)[words.owner]
    place = np.arange(len(values)) - words.first[words.owner]
    at = np.flatnonzero(place + length <= n_words[words.owner])
    hashes = WORDS.spans(values, at, at + length[at])
    hashes = mix(hashes ^ (length[at].astype(np.uint64) << np.uint64(56)))
    owner = words.owner[at]
    order = np.argsort((owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    if (np.diff(hashes[order] >> np.uint64(20)) == 0).any():
        order = np.lexsort((hashes, owner))  # settles ties of the leading bits too
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[new], hashes[new]
    return owner, hashes, np.bincount(owner, minlength=len(offsets) - 1)


def _digests(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums of each set, whatever the order of its members."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(salt)), out=sums[1:])
        ends = np.searchsorted(owner, np.arange(n + 1))
        out.append(mix(sums[ends[1:]] - sums[ends[:-1]]))
    return out[0], out[1]


def _sketches(owner: np.ndarray, hashes: np.ndarray, size: np.ndarray) -> pa.Array:
    """For each set, whether an odd number of its members falls to each bit of its sketch.

    Two sets differ by at least as many members as bits of their sketches differ.
    A sketch is folded to half its width by xor of its halves.
    """
    width = np.maximum(SKETCH, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    edges = np.concatenate([[0], np.cumsum(width)])
    bit = (mix(hashes) & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(edges[owner] + bit, minlength=int(edges[-1])) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array((edges // 64).astype(np.int32)), pa.array(np.packbits(odd).view(np.int64)))


def _firsts(d1: np.ndarray, d2: np.ndarray, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Flags of the least document of each class of equal sets; empty sets are none."""
    order = np.lexsort((ids, d2, d1))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
    flags = np.zeros(len(order), dtype=bool)
    flags[order[new]] = True
    return flags & (size > 0)


_FACTS = ["doc_id", "n", "d1", "d2", "shingle", "sketch"]


def _in_several(hashes: np.ndarray) -> pa.RecordBatch:
    """A row for each of hashes that is there more than once, with its number. Sorts hashes."""
    hashes.sort()
    found, count = np.unique(hashes[1:][hashes[1:] == hashes[:-1]], return_counts=True)
    nulls = pa.nulls(len(found), pa.int64())
    shingle, sketch = pa.array(found.view(np.int64)), pa.nulls(len(found), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([nulls, pa.array(count + 1), nulls, nulls, shingle, sketch], _FACTS)


def _facts(batches):
    """A row for each text (its set's size, digests and sketch), and one for each shingle that
    several different sets hold (with their number; text rows have shingle NULL). HELD shingles
    are looked at together, whatever the size of the batches."""
    held, filled = np.empty(HELD, dtype=np.uint64), 0
    for batch in blocks(batches, "text", BLOCK):
        all_ids = batch.column("doc_id")
        for lo, hi, data, offsets in chunks(batch.column("text"), BLOCK):
            n = hi - lo
            owner, hashes, size = shingle_sets(data, offsets)
            d1, d2 = _digests(owner, hashes, n)
            ids = all_ids.slice(lo, n).fill_null(np.iinfo(np.int64).max).to_numpy()
            columns = [pa.array(x) for x in (size.astype(np.int64), d1.view(np.int64), d2.view(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [all_ids.slice(lo, n), *columns, pa.nulls(n, pa.int64()), _sketches(owner, hashes, size)], _FACTS
            )
            hashes = hashes[_firsts(d1, d2, ids, size)[owner]]
            while len(hashes):
                now = hashes[: HELD - filled]
                held[filled : filled + len(now)] = now
                hashes, filled = hashes[len(now) :], filled + len(now)
                if filled == HELD:
                    yield _in_several(held)
                    filled = 0
    if filled:
        yield _in_several(held[:filled])


def _subset_rows(hashes: np.ndarray, n: int) -> list[tuple[int, bool]]:
    """(signature, whether for a partner of another size) of the fixed-size subsets."""
    out = []
    for m in partners(n):
        k = needed(n, m)
        if k > min(n, m):
            continue
        salt = np.uint64(min(n, m) * 1_000_003 + max(n, m))
        picks = np.array(list(itertools.combinations(range(n), k)), dtype=np.int64).reshape(-1, k)
        sums = mix(hashes)[picks].sum(axis=1, dtype=np.uint64)
        out += [(int(s), m != n) for s in mix(sums ^ mix(np.array([salt]))).view(np.int64)]
    return out


def _postings(heavy: np.ndarray, small: int):
    """Rows (key, doc_id, n, left, kind): list postings, kind 0, heavy ones 1, and subsets, 2 or 3.

    left counts the shingles of the set from this one on in the order.

    Of equal sets in the block only the least document sends rows.
    """
    least_listed = min(partners(small + 1))

    def each(batches):
        for batch in blocks(batches, "text", BLOCK // 2):
            all_ids = batch.column("doc_id").to_numpy()
            for lo, hi, data, offsets in chunks(batch.column("text"), BLOCK // 2):
                ids = all_ids[lo:hi]
                owner, hashes, size = shingle_sets(data, offsets)
                first = _firsts(*_digests(owner, hashes, hi - lo), ids, size)
                keep = first[owner]
                owner, hashes = owner[keep], hashes[keep]
                at = np.minimum(np.searchsorted(heavy, hashes), max(len(heavy) - 1, 0))
                common = heavy[at] == hashes if len(heavy) else np.zeros(len(hashes), dtype=bool)
                order = np.lexsort((hashes, common, owner))
                owner, hashes, common = owner[order], hashes[order], common[order]
                start = np.searchsorted(owner, np.arange(hi - lo))
                place = np.arange(len(owner)) - start[owner]
                sent = (place < prefix(size)[owner]) & (size[owner] >= least_listed)
                keys, docs, kinds = [hashes[sent].view(np.int64)], [owner[sent]], [common[sent].astype(np.int8)]
                left = [(size[owner] - place)[sent]]
                for i in np.flatnonzero(first & (size <= small) & (size > 1)):
                    rows = _subset_rows(hashes[start[i] : start[i] + size[i]], int(size[i]))
                    keys.append(np.array([r[0] for r in rows], dtype=np.int64))
                    docs.append(np.full(len(rows), i))
                    left.append(np.zeros(len(rows), dtype=np.int64))
                    kinds.append(np.array([2 + r[1] for r in rows], dtype=np.int8))
                who = np.concatenate(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)),
                        pa.array(ids[who]),
                        pa.array(size[who].astype(np.int32)),
                        pa.array(np.concatenate(left).astype(np.int32)),
                        pa.array(np.concatenate(kinds)),
                    ],
                    ["key", "doc_id", "n", "left", "kind"],
                )

    return each


def _slices(batch: pa.RecordBatch, size: int = 4 * CHUNK):
    """The batch in slices of about that many bytes of text."""
    bytes_of = lambda c: batch.column(c).cast(pa.binary()).fill_null(b"")
    length = sum(pc.binary_length(bytes_of(c)).to_numpy().astype(np.int64) for c in ("text_a", "text_b"))
    edges = np.concatenate([[0], np.cumsum(length)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(int(np.searchsorted(edges, edges[lo] + size)) - 1, lo + 1)
        yield batch.slice(lo, min(hi, batch.num_rows) - lo)
        lo = hi


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of all sets of a column, and their sizes."""
    parts = [(lo, *shingle_sets(data, offsets)) for lo, _, data, offsets in chunks(column)]
    owner, hashes, size = (np.concatenate(x) for x in zip(*[(lo + o, h, n) for lo, o, h, n in parts], strict=True))
    return owner, hashes, size


def _linked(batches):
    """Keeps the pairs (a, b) whose texts share enough shingles."""
    for batch in batches:
        for part in _slices(batch):
            owner, hashes, size_a = _sets(part.column("text_a"))
            owner_b, hashes_b, size_b = _sets(part.column("text_b"))
            met = np.isin(keyed(hashes, owner), keyed(hashes_b, owner_b))
            common = np.bincount(owner[met], minlength=part.num_rows)
            union = size_a + size_b - common
            good = pa.array((OUT_OF * common >= SHARE * union) & (common > 0))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(good), part.column("b").filter(good)], ["a", "b"])


def _near_enough(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches don't rule out that they are linked."""

    def side(i: str) -> DataFrame:
        return sketches.select(F.col("doc_id").alias(i), F.col("n").alias(f"n{i}"), F.col("sketch").alias(f"s{i}"))

    near = SHARE * F.greatest("na", "nb") <= OUT_OF * F.least("na", "nb")
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(near)

    def folded(mine: str, other: str) -> Column:
        """Sets of sizes so near differ by one doubling of width at most."""
        half = (F.size(mine) / 2).cast("int")
        halves = F.zip_with(F.slice(mine, 1, half), F.slice(mine, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(mine) > F.size(other), halves).otherwise(F.col(mine))

    bits = F.zip_with(folded("sa", "sb"), folded("sb", "sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    may = differ <= F.col("na") + F.col("nb") - 2 * needed_column(F.col("na"), F.col("nb"))
    return met.where(may).select("a", "b").distinct()


def _in_buckets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts whose doc_id falls into a bucket that one of ids falls into."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")
    touched = ids.select(bucket("id").alias("touched")).distinct()
    return texts.join(F.broadcast(touched), bucket("doc_id") == touched["touched"], "left_semi")


def _tested(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents that are linked, by their whole texts.

    Only pairs that their sketches leave open are tested. Texts whose doc_id falls
    into none of the buckets that the pairs touch stay out of the shuffle: the
    table of buckets has BUCKETS rows at most.
    """
    pairs = staged(_near_enough(pairs, sketches), "pairs")
    texts = _in_buckets(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return met.mapInArrow(_linked, "a bigint, b bigint")


def _pairs(rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of rows with x and y, smaller first."""
    return rows.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _possible(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb, met) that met often enough in lists to be linked at all.

    Of what two linked sets share, all but the larger rest behind a prefix shows
    in the prefixes.
    """
    n, m = F.col("na"), F.col("nb")
    rest = F.greatest(n - prefix_column(n), m - prefix_column(m))
    near = SHARE * F.greatest(n, m) <= OUT_OF * F.least(n, m)
    return pairs.where(near & (F.col("met") + rest >= needed_column(n, m)))


def _may_start() -> Column:
    """Whether x and y may be linked with this list as the first that they share.

    From the first shared shingle on, both sets must hold as many as are needed.
    """
    return needed_column(F.col("nx"), F.col("ny")) <= F.least("left_x", "left_y")


def document_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n, d1, d2, rep) of each text, (shingle, n) of those that several texts of a batch hold,
    and (doc_id, n, sketch) of each text that has shingles."""
    kinds = "doc_id bigint, n bigint, d1 bigint, d2 bigint, shingle bigint, sketch array<bigint>"
    facts = staged(docs.mapInArrow(_facts, kinds), "facts")
    texts = facts.where("shingle is null").drop("shingle")
    sketches = texts.where("n > 0 and doc_id is not null").select("doc_id", "n", "sketch")
    reps = texts.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = texts.join(reps, ["n", "d1", "d2"], "left").select(
        "doc_id", "n", "d1", "d2", F.coalesce("rep", "doc_id").alias("rep")
    )
    return classes, facts.where("shingle is not null").select("shingle", "n"), sketches


def _heavy(shingles: DataFrame, texts: int) -> np.ndarray:
    """Sorted hashes of the heavy shingles: at most HEAVY_ONE_IN times the mean set size."""
    least = max(HEAVY_LEAST, texts // HEAVY_ONE_IN)
    found = shingles.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = found.select("shingle").toArrow().column(0).to_numpy()
    return np.sort(rows.view(np.uint64))


def links(docs: DataFrame, classes: DataFrame, shingles: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): links between class representatives that join all linked texts together."""
    size = classes.where("n > 0")
    counted = {r["n"]: r["count"] for r in size.where(f"n <= {LARGEST_SMALL * 2}").groupBy("n").count().collect()}
    texts = docs.where("doc_id is not null and text is not null")
    heavy = _heavy(shingles, classes.count())
    rows = staged(
        texts.mapInArrow(_postings(heavy, boundary(counted)), "key bigint, doc_id bigint, n int, left int, kind byte"),
        "postings",
        "lz4",
    )

    # Light lists by window: each holds less than one of HEAVY_ONE_IN texts, about. Heavy ones,
    # and subsets, by partial minima joined back, a join that splits a hot key. A posting goes
    # if the list has no set of a size that could be linked with its own, or of two that it
    # holds one comes too late in its set.
    whole, by_size = Window.partitionBy("key"), Window.partitionBy("key").orderBy("n")
    beside = lambda m: SHARE * F.greatest(F.col("n"), m) <= OUT_OF * F.least(F.col("n"), m)
    partner = beside(F.lag("n").over(by_size)) | beside(F.lead("n").over(by_size))
    other = {c: F.sum(c).over(whole) - F.col(c) for c in ("n", "left")}
    in_time = needed_column(F.col("n"), other["n"]) <= F.least("left", other["left"])
    light = (
        rows.where("kind = 0")
        .withColumns(
            {
                "partner": F.coalesce(partner, F.lit(False)),
                "of_two": F.count("*").over(whole) == 2,
                "in_time": in_time,
                "hub": F.min("doc_id").over(whole),
                "last": F.max("doc_id").over(whole),
            }
        )
        .where("hub < last and partner and (in_time or not of_two)")
        .select("key", "doc_id", "n", "left", "hub")
    )
    listed = rows.where("kind = 1")
    hubs = listed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last")
    shared = staged(
        light.unionByName(listed.join(hubs.drop("last"), "key").select("key", "doc_id", "n", "left", "hub")), "lists"
    )
    subsets = rows.where("kind >= 2")
    ends = subsets.groupBy("key", "kind").agg(
        F.min(F.struct("n", "doc_id")).alias("small"), F.max(F.struct("n", F.negative("doc_id").alias("d"))).alias("large")
    )
    far = F.when(F.col("n") == F.col("small.n"), F.negative("large.d")).otherwise(F.col("small.doc_id"))
    met = (
        subsets.join(ends, ["key", "kind"])
        .where("kind = 2 or small.n < large.n")
        .select(F.col("doc_id").alias("x"), F.when(F.col("kind") == 2, F.col("small.doc_id")).otherwise(far).alias("y"))
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )

    # A doc_id whose texts of one size are of several classes stands for itself, with all its texts.
    one = F.when(F.min("rep") == F.max("rep"), F.min("rep")).otherwise(F.col("doc_id"))
    rep = classes.where("doc_id is not null and n > 0").groupBy("doc_id", "n").agg(one.alias("rep"))
    by_size = lambda side, n: rep.select(F.col("doc_id").alias(side), F.col("n").alias(n), F.col("rep").alias(f"rep_{side}"))

    # Step 1: least text of each list.
    starred = shared.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("hub").alias("y")).where("x <> y")
    starred = starred.groupBy("x", "nx", "y").agg(F.count("*").alias("met")).join(by_size("y", "ny"), "y")
    starred = (
        starred.select(
            F.col("x").alias("b"), F.col("nx").alias("nb"), F.col("y").alias("a"), F.col("ny").alias("na"),
            "met", F.col("rep_y").alias("ra"),
        )
        .transform(_possible)
        .join(by_size("b", "nb").withColumnRenamed("rep_b", "rb"), ["b", "nb"])
        .where("ra <> rb")
        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
    )
    found = staged(_tested(starred.unionByName(met).distinct(), texts, sketches), "links")

    # Step 2: long lists of several components, in random orders.
    def holders(edges: DataFrame) -> DataFrame:
        """Postings of class representatives in lists that hold more than one component."""
        joined = components(edges)
        held = (
            shared.join(rep, ["doc_id", "n"])
            .select("key", "rep", "n", "left")
            .distinct()
            .join(joined, F.col("rep") == F.col("vertex"), "left")
            .select("key", "rep", "n", "left", F.coalesce("component", "rep").alias("component"))
        )
        return staged(held, "lists")

    held = holders(found)
    several = held.groupBy("key").agg(
        F.count("*").alias("texts"), F.min("component").alias("first"), F.max("component").alias("last")
    )
    several = several.where("first < last")
    long = held.join(several.where(F.col("texts") >= LONG).select("key"), "key")
    turns = long.withColumn("turn", F.explode(F.array(*[F.lit(i) for i in range(ORDERS)])))
    line = Window.partitionBy("key", "turn").orderBy(F.xxhash64("rep", "turn"), "rep")
    beside = turns.select(
        F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("left").alias("left_x"), "component",
        F.lead("rep").over(line).alias("y"), F.lead("n").over(line).alias("ny"), F.lead("left").over(line).alias("left_y"),
        F.lead("component").over(line).alias("other"),
    ).where((F.col("component") != F.col("other")) & _may_start())
    chained = _tested(_pairs(beside), texts, sketches)
    found = staged(found.unionByName(chained).distinct(), "links")

    # Step 3: all pairs of different components that share a list.
    held = holders(found)
    several = held.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    open_lists = held.join(several.where("first < last").select("key"), "key")
    side = lambda i: open_lists.select(
        "key", F.col("rep").alias(i), F.col("n").alias(f"n{i}"), F.col("left").alias(f"left_{i}"), F.col("component").alias(f"c{i}")
    )
    rest = _pairs(side("x").join(side("y"), "key").where((F.col("cx") < F.col("cy")) & _may_start()))
    return found.unionByName(_tested(rest, texts, sketches)).distinct()


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of BATCH_ROWS rows for the jobs that run inside: a row may be a whole text, or two."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _grouped(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n, rep, component) of each text, and its columns d1 and d2 if asked for."""
    with _small_batches(docs.sparkSession):
        classes, shingles, sketches = document_classes(docs)
    classes = staged(classes.select("doc_id", "n", "rep", *more), "classes")
    held = classes.where("doc_id is not null and n > 0")
    twice = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    same = held.join(twice.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    with _small_batches(docs.sparkSession):
        joined = components(links(docs, classes, shingles, sketches).unionByName(same))
    return classes.join(joined, F.col("rep") == F.col("vertex"), "left").select(
        "doc_id", "n", "rep", *more, F.coalesce("component", "rep").alias("component")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs.

    component_id is the least doc_id that links reach. Rows that share a doc_id
    are one document, linked by any of their texts. NULL and empty texts have no
    shingles and link with nothing. A row without doc_id takes no part and gets
    no component.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray] | None, n: int, m: int) -> np.ndarray:
    """Shingles that each of n sets a, given as (set, hash), shares with each of m sets b, or of a itself."""
    values, count = np.unique(a[1], return_counts=True)
    shared = values[count > 1] if b is None else np.intersect1d(values, np.unique(b[1]), assume_unique=True)
    out = np.zeros((n, m), dtype=np.int64)
    if not len(shared):
        return out

    def placed(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(shared, hashes), len(shared) - 1)
        met = shared[at] == hashes
        order = np.argsort(at[met], kind="stable")
        return owner[met][order], at[met][order]

    def slice_of(rows: tuple[np.ndarray, np.ndarray], size: int, lo: int, hi: int) -> np.ndarray:
        i, j = np.searchsorted(rows[1], [lo, hi])
        flags = np.zeros((size, hi - lo), dtype=np.float32)
        flags[rows[0][i:j], rows[1][i:j] - lo] = 1
        return flags

    left = placed(*a)
    right = left if b is None else placed(*b)
    for lo in range(0, len(shared), COLUMNS):
        hi = min(lo + COLUMNS, len(shared))
        ours = slice_of(left, n, lo, hi)
        out += (ours @ (ours if b is None else slice_of(right, m, lo, hi)).T).astype(np.int64)
    return out


def _part_links(rows: pa.Table) -> pa.Table:
    """(n, d1, d2, links): rows of docs linked with each class of two parts, from the other part.

    side tells the parts apart; a part that meets itself has side 0 alone. Texts
    that the doc_id of a class holds besides the class' own are left out by their digests.
    """
    owner, hashes, size = _sets(rows.column("text").combine_chunks())
    own1, own2 = (d.view(np.int64) for d in _digests(owner, hashes, rows.num_rows))
    side, d1, d2, weight = (rows.column(c).to_numpy() for c in ("side", "d1", "d2", "rows"))
    right = (own1 == d1) & (own2 == d2) & (size == rows.column("n").to_numpy())
    at = np.flatnonzero(right)
    at = at[np.unique(np.stack([side[at].astype(np.int64), d1[at], d2[at]]), axis=1, return_index=True)[1]]
    parts = [np.sort(at[side[at] == k]) for k in (0, 1)]
    itself = rows.column("itself")[0].as_py()

    def sets_of(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(rows.num_rows, -1, dtype=np.int64)
        place[part] = np.arange(len(part))
        held = place[owner] >= 0
        return place[owner[held]], hashes[held]

    a, b = parts[0], parts[0] if itself else parts[1]
    common = _common(sets_of(a), None if itself else sets_of(b), len(a), len(b))
    linked = (OUT_OF * common >= SHARE * (size[a][:, None] + size[b][None, :] - common)) & (common > 0)
    if itself:
        np.fill_diagonal(linked, False)
    found = [(a, linked @ weight[b])] + ([] if itself else [(b, weight[a] @ linked)])
    who, total = (np.concatenate(x) for x in zip(*found, strict=True))
    who, total = who[total > 0], total[total > 0]
    return pa.table(
        [pa.array(size[who].astype(np.int64)), pa.array(d1[who]), pa.array(d2[who]), pa.array(total.astype(np.int64))],
        ["n", "d1", "d2", "links"],
    )


def _class_links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(n, d1, d2, links): how many rows of other classes each class is linked with.

    classes has (component, n, d1, d2, rep, rows). Bands of sizes of a component are
    cut by hash into parts; each part meets itself, the later ones of its band, and all
    parts of the next band. Other pairs of sizes can't be linked.
    """
    several = classes.groupBy("component").agg(F.count("*").alias("classes")).where("classes > 1").drop("classes")
    held = classes.join(several, "component").withColumn("band", F.floor(F.log("n") / F.lit(math.log(BAND))).cast("int"))
    of_band = staged(
        held.groupBy("component", "band").agg(
            F.greatest(F.ceil(F.sum("n") / PART_SHINGLES), F.ceil(F.count("*") / PART_TEXTS)).cast("int").alias("parts")
        ),
        "bands",
    )
    near = lambda step, name: of_band.select("component", (F.col("band") + step).alias("band"), F.col("parts").alias(name))
    keys = ["component", "band"]
    held = held.join(of_band, keys).join(near(-1, "above"), keys, "left").join(near(1, "below"), keys, "left")
    held = staged(held.withColumn("part", F.pmod(F.xxhash64("d1", "d2"), "parts").cast("int")), "held")

    def spots(upto: Column, first: Column, band: Column, far: bool, mine_first: bool) -> Column:
        """Where the part meets parts from first to upto - 1."""

        def spot(k: Column) -> Column:
            i, j = (F.col("part"), k) if mine_first else (k, F.col("part"))
            return F.struct(
                band.alias("band"), F.lit(far).alias("far"), i.alias("i"), j.alias("j"),
                F.lit(0 if mine_first else 1).alias("side"),
            )

        return F.when(upto > first, F.transform(F.sequence(first, upto - 1), spot)).otherwise(
            F.array().cast("array<struct<band:int,far:boolean,i:int,j:int,side:int>>")
        )

    zero = F.lit(0)
    meets = F.concat(
        spots(F.col("parts"), F.col("part"), F.col("band"), False, True),
        spots(F.col("part"), zero, F.col("band"), False, False),
        spots(F.coalesce("above", zero), zero, F.col("band"), True, True),
        spots(F.coalesce("below", zero), zero, F.col("band") - 1, True, False),
    )
    wanted = held.select("component", "n", "d1", "d2", "rep", "rows", meets.alias("meets"))
    texts = _in_buckets(texts, held.select(F.col("rep").alias("id")))
    rows = wanted.join(texts, wanted["rep"] == texts["doc_id"]).select(
        "component", "n", "d1", "d2", "rows", "text", F.explode("meets").alias("at")
    )
    rows = rows.select(
        "component", "n", "d1", "d2", "rows", "text", "at.*", (~F.col("at.far") & (F.col("at.i") == F.col("at.j"))).alias("itself")
    )
    found = rows.groupBy("component", "band", "far", "i", "j").applyInArrow(
        _part_links, "n bigint, d1 bigint, d2 bigint, links bigint"
    )
    return found.groupBy("n", "d1", "d2").agg(F.sum("links").alias("links"))


def link_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, n_links) for each row of docs.

    n_links counts the other rows of docs whose texts are linked with the row's
    own, equal sets included, whatever their component was joined by; class_id is the
    least doc_id with an equal set. Rows that share a doc_id count one by one. NULL and
    empty texts have no links; for a row without doc_id class and links are NULL, and
    it counts for no other.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    grouped = staged(_grouped(docs, "d1", "d2"), "groups")
    held = grouped.where("doc_id is not null and n > 0")
    classes = held.groupBy("component", "n", "d1", "d2").agg(F.min("rep").alias("rep"), F.count("*").alias("rows"))
    classes = staged(classes, "weights")
    found = _class_links(classes, docs.where("doc_id is not null and text is not null"))
    key = ["n", "d1", "d2"]
    total = classes.join(found, key, "left").select(*key, (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("total"))
    known = F.col("doc_id").isNotNull()
    return grouped.join(total, key, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(known, F.col("component")).alias("component_id"),
        F.when(known, F.col("rep")).alias("class_id"),
        F.when(known, F.when(F.col("n") > 0, F.col("total")).otherwise(F.lit(0))).alias("n_links"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one with the least doc_id, with the columns of docs.

    Of rows that share a doc_id one stays; rows without doc_id all stay.
    """
    gone_id, turn = free_name(docs, "gone"), free_name(docs, "turn")
    gone = near_duplicates(docs, doc_id, text).where("component_id < doc_id")
    gone = gone.select(F.col("doc_id").alias(gone_id)).distinct()
    left = docs.join(gone, docs[doc_id] == gone[gone_id], "left_anti")
    order = Window.partitionBy(doc_id).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    numbered = left.where(F.col(doc_id).isNotNull()).withColumn(turn, F.row_number().over(order))
    return numbered.where(F.col(turn) == 1).drop(turn).unionByName(left.where(F.col(doc_id).isNull()))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
