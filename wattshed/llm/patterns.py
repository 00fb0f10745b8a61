"""Best-fit packing by length patterns, fitted by non-negative least squares.

How texts of a length share sequences depends only on how many texts there are of
each length, so the packing is planned from the histogram of lengths, which has no
more rows than a sequence has places, and each text then finds its place by its
number among the texts of its length.

The plan has three parts. Lengths are put into GRADES classes, and patterns of up
to PARTS classes that can fill a sequence just so are enumerated. Non-negative least
squares (an active set of patterns, grown by the steepest gradient) says how often
to repeat each so that the patterns together use the histogram up; counts are
rounded and held to the texts there are. A repeated pattern takes texts of actual
lengths, the longest first and the last as long as still fits. What is left is
packed by falling length into the sequence, full or begun, where the least room
remains. Equal sequences are kept as one row with a count throughout, so the work
grows with the number of lengths and not of texts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattshed.llm.common import staged, table
from wattshed.llm.packing import coder, tokenizer_path
from wattshed.llm.words import chunks

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_OF_TEXT = 1
GRADES, PARTS = 64, 3
#: Rows of pieces in an Arrow batch.
ROWS = 4000


def patterns(grades: int, parts: int) -> np.ndarray:
    """Multisets of up to parts classes that can fill grades just so, as counts by class.

    A text of a class may be shorter than the class by almost one grade, so k
    classes may add up to k - 1 more than grades.
    """
    found: list[list[int]] = []

    def grow(left: int, most: int, chosen: list[int], size: int) -> None:
        if len(chosen) == size:
            if not left:
                found.append(chosen)
            return
        more = size - len(chosen)
        for g in range(min(left - more + 1, most), -(-left // more) - 1, -1):
            grow(left - g, g, [*chosen, g], size)

    for size in range(1, parts + 1):
        for total in range(grades, grades + size):
            grow(total, grades, [], size)
    counts = np.zeros((len(found), grades + 1), dtype=np.float64)
    for i, chosen in enumerate(found):
        np.add.at(counts[i], chosen, 1)
    return counts


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 with least |ax - b|, by an active set: few entries of x are not 0."""
    x = np.zeros(a.shape[1])
    active: list[int] = []
    slope = a.T @ b
    limit = tolerance * max(1.0, float(np.abs(slope).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        outside = slope.copy()
        outside[active] = -np.inf
        best = int(np.argmax(outside))
        if outside[best] <= limit:
            break
        active.append(best)
        while True:
            fit = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = fit <= 0
            if not low.any():
                break
            old = x[active]
            step = np.min(old[low] / np.maximum(old[low] - fit[low], 1e-300))
            moved = old + step * (fit - old)
            stay = ~(low & (moved <= 1e-12 * max(1.0, float(np.abs(moved).max()))))
            if stay.all():
                stay[np.flatnonzero(low)[np.argmin(moved[low])]] = False
            x[active] = 0
            x[[v for v, s in zip(active, stay, strict=True) if s]] = np.maximum(moved[stay], 0)
            active = [v for v, s in zip(active, stay, strict=True) if s]
            if not active:
                fit = np.zeros(0)
                break
        x[active] = fit
        slope = a.T @ (b - a[:, active] @ x[active])
    return x


class Lengths:
    """Lengths that texts are left of, and how many."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: c for n, c in counts.items() if c}
        self.order = sorted(self.left)

    def longest(self, low: int, high: int) -> int | None:
        """The longest from low to high."""
        i = bisect_left(self.order, high + 1) - 1
        return self.order[i] if i >= 0 and self.order[i] >= low else None

    def shortest(self, low: int, high: int) -> int | None:
        """The shortest from low to high."""
        i = bisect_left(self.order, low)
        return self.order[i] if i < len(self.order) and self.order[i] <= high else None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.order.pop(bisect_left(self.order, length))


@dataclass
class Plan:
    """Groups of equal sequences: how many, and the lengths in each, in order."""

    groups: list[tuple[int, list[int]]]

    def __post_init__(self):
        """Arrays by length: from which text on each run of places is, and where those places are."""
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        number = 0
        for count, lengths in self.groups:
            offset, i = 0, 0
            while i < len(lengths):
                j = i
                while j < len(lengths) and lengths[j] == lengths[i]:
                    j += 1
                runs.setdefault(lengths[i], []).append((count * (j - i), number, j - i, offset))
                offset += lengths[i] * (j - i)
                i = j
            number += count
        self.sequences = number
        self.places = {}
        for length, rows in runs.items():
            size, first, each, offset = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
            self.places[length] = (np.cumsum(size) - size, first, each, offset)

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of texts, by length and number among the texts of that length."""
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
        for a, b in pairwise(edges):
            own = order[a:b]
            begin, first, each, at = self.places[int(length[own[0]])]
            run = np.searchsorted(begin, number[own], side="right") - 1
            sequence[own] = first[run] + (number[own] - begin[run]) // each[run]
            offset[own] = at[run] + (number[own] - begin[run]) % each[run] * length[own]
        return sequence, offset


def _patterned(lengths: Lengths, capacity: int, grades: int, parts: int) -> list[tuple[int, list[int]]]:
    """Sequences by fitted patterns; takes their texts out of lengths."""
    if not lengths.order:
        return []
    width = -(-capacity // grades)
    grades = -(-capacity // width)
    edge = [min(g * width, capacity) for g in range(grades + 1)]
    histogram = np.zeros(grades + 1)
    for n, c in lengths.left.items():
        histogram[-(-n // width)] += c
    columns = patterns(grades, parts)
    columns = columns[(columns[:, histogram == 0] == 0).all(axis=1)]
    if not len(columns):
        return []
    # Long texts must be met; short ones find room among what is left. Shares, so that size plays no part.
    weight = np.sqrt(np.array(edge, dtype=np.float64) / capacity)[1:]
    repeats = nonnegative_least_squares((columns.T[1:] * weight[:, None]), histogram[1:] / histogram.sum() * weight)
    repeats = np.rint(repeats * histogram.sum()).astype(np.int64)
    groups = []
    for i in np.argsort(-repeats, kind="stable").tolist():
        classes = [g for g in range(grades, 0, -1) for _ in range(int(columns[i, g]))]
        count = int(repeats[i])
        while count > 0:
            chosen: list[int] = []
            room, used = capacity, {}
            least = [lengths.shortest(edge[g - 1] + 1, edge[g]) for g in classes]
            if None in least:
                break
            for k, g in enumerate(classes):
                # Room for the shortest of the classes to come; the last one may be longer than its class.
                low, high = edge[g - 1] + 1, room - sum(least[k + 1 :])
                if k + 1 < len(classes):
                    high = min(high, edge[g])
                n = lengths.longest(low, high)
                while n is not None and used.get(n, 0) >= lengths.left[n]:
                    n = lengths.longest(low, n - 1)
                if n is None:
                    break
                chosen.append(n)
                used[n] = used.get(n, 0) + 1
                room -= n
            if len(chosen) < len(classes):
                break
            times = min([count, *(lengths.left[n] // u for n, u in used.items())])
            for n, u in used.items():
                lengths.take(n, times * u)
            groups.append((times, chosen))
            count -= times
    return groups


def plan(counts: dict[int, int], capacity: int = CAPACITY, grades: int = GRADES, parts: int = PARTS) -> Plan:
    """How to pack so many texts of each length, none longer than capacity."""
    lengths = Lengths(counts)
    # Sequences as (how many, chain of lengths), by room left.
    rooms: dict[int, list] = {}
    order: list[int] = []

    def put(room: int, count: int, chain) -> None:
        if room not in rooms:
            insort(order, room)
            rooms[room] = []
        rooms[room].append((count, chain))

    for count, chosen in _patterned(lengths, capacity, grades, parts):
        chain = None
        for n in chosen:
            chain = (n, chain)
        put(capacity - sum(chosen), count, chain)
    for n in sorted(lengths.left, reverse=True):
        left = lengths.left[n]
        while left:
            i = bisect_left(order, n)
            if i == len(order):
                each = capacity // n
                full, rest = divmod(left, each)
                for count, size in ((full, each), (1, rest)):
                    if count and size:
                        chain = None
                        for _ in range(size):
                            chain = (n, chain)
                        put(capacity - size * n, count, chain)
                break
            room = order[i]
            count, chain = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], order[i]
            used = min(count, left)
            if used < count:
                put(room, count - used, chain)
            put(room - n, used, (n, chain))
            left -= used
    groups = []
    for room in order:
        for count, chain in rooms[room]:
            chosen = []
            while chain:
                chosen.append(chain[0])
                chain = chain[1]
            groups.append((count, sorted(chosen, reverse=True)))
    return Plan(groups)


_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    """Pieces of each text, numbered by length within the task's part of the texts."""

    def each(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            docs = batch.column("doc_id")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                ids, begins = coder(path).encode(data, offsets)
                ids = ids.astype("<u4")
                ids[begins[1:] - 1] = end_id
                many = -(-np.diff(begins) // capacity)
                owner = np.repeat(np.arange(hi - lo), many)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                begin = begins[owner] + start
                length = np.minimum(capacity, begins[owner + 1] - begin)
                order = np.argsort(length, kind="stable")
                edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
                number = np.empty(len(owner), dtype=np.int64)
                number[order] = np.arange(len(owner)) - np.repeat(edges[:-1], np.diff(edges)) + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [
                    docs.take(pa.array(lo + owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(owner), part, dtype=np.int32)), pa.array(number),
                ]
                names = [c.split()[0] for c in _PIECES.split(", ")]
                if with_ids:  # the pieces of a chunk lie one behind the other
                    places = np.append(begin, begins[-1]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(places), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=ROWS)

    return each


def _placed(shared):
    def each(batches):
        plan: Plan = shared.value
        for batch in batches:
            number = batch.column("number").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = plan.place(batch.column("length").to_numpy(), number)
            kept = [n for n in batch.schema.names if n not in ("part", "number", "before")]
            columns = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return each


def pattern_packed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_OF_TEXT,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: its document, number and place there, its sequence and place there, its ids.

    A text is its ids and end_id; NULL and empty texts are end_id alone. Texts longer
    than capacity are cut into full pieces and a rest, others stay whole. Each row of
    docs is packed for itself, repeated ones and those without doc_id too; extra
    columns are left out, whatever their names; a table without rows has no pieces.
    Sequences are numbered from 0 without gaps, offsets in one from 0 without gaps.
    with_ids=False leaves the ids out and keeps their checksum.

    Texts are not shuffled; a piece's row (without its ids, if they are left out)
    is written and meets the number of like pieces in the parts before its own.
    """
    spark = docs.sparkSession
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    pieces = staged(own.mapInArrow(_cut(tokenizer_path(tokenizer), capacity, end_id, with_ids), schema), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    shared = spark.sparkContext.broadcast(plan(histogram, capacity))
    out = pieces.drop("part", "number").schema.add("sequence_id", "long").add("offset", "long")
    numbered = pieces.join(before, ["part", "length"]).select(*pieces.columns, "before")
    return numbered.mapInArrow(_placed(shared), out)


def op12_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packed(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
