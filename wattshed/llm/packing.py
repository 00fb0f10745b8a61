"""Packing of token ids into sequences of fixed length, by minimum bin slack.

Each task packs the texts of its own partition, so nothing is shuffled and no
task depends on another; a partition wastes less than its last sequences. Texts
longer than a sequence are cut into full ones and a rest. A window then takes the
longest rest left and fills what remains of it as closely as the rests at hand
allow: a subset-sum table, one bit for each total, grows by one length at a time
(its count taken in powers of two) until the capacity is reached or all lengths
are in; going back through the table gives how many of each length to take.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from wattshed.llm.common import table
from wattshed.llm.words import FOLD, chunks, span_hashes, words_of

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_OF_TEXT = 2
#: Distinct words that a task remembers before it starts afresh.
REMEMBERED = 800_000
#: Words that go through the library at a time.
LEARNED = 10_000

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class WordCoder:
    """Ids of texts from a tokenizer that lower-cases and never looks across white space.

    Each distinct word of a task goes through the library once. Words that differ
    in the case of A-Z only, or in a mark of MARKS behind a letter of A-Z, share
    their ids; words with a "<", which may start an added token, stay as they are.
    """

    MARKS = b".,;:!?"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer  # after the setting, which it reads once

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.forget()

    def forget(self) -> None:
        self.known, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self.begins = self.counts

    def _spans(self, data: np.ndarray, words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Folded bytes, and (start, end, text) of words and of the marks cut off from them."""
        folded = FOLD[data]
        start, end, owner = words.start, words.end, words.owner
        odd = np.zeros(len(start), dtype=bool)
        odd[np.searchsorted(start, np.flatnonzero(data == ord("<")), side="right") - 1] = True
        for i in np.flatnonzero(odd):
            folded[start[i] : end[i]] = data[start[i] : end[i]]
        mark = np.zeros(256, dtype=bool)
        mark[list(self.MARKS)] = True
        last, before = folded[end - 1], folded[end - 2]
        cut = mark[last] & (end - start > 1) & (before >= ord("a")) & (before <= ord("z")) & ~odd
        at = np.flatnonzero(cut)
        heads = end - cut
        return (
            folded,
            np.insert(start, at + 1, end[at] - 1),
            np.insert(heads, at + 1, end[at]),
            np.insert(owner, at + 1, owner[at]),
        )

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        flats, counted = [], []
        for lo in range(0, len(texts), LEARNED):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo : lo + LEARNED], add_special_tokens=False)]
            counted.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
            flats.append(np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(counted[-1].sum())))
        flat, counts = np.concatenate(flats), np.concatenate(counted)
        known = np.concatenate([self.known, keys])
        slots = np.concatenate([self.slots, np.arange(len(keys)) + len(self.counts)])
        order = np.argsort(known)
        self.known, self.slots = known[order], slots[order]
        self.ids, self.counts = np.concatenate([self.ids, flat]), np.concatenate([self.counts, counts])
        self.begins = np.cumsum(self.counts) - self.counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, END_OF_TEXT behind each, and where each text's begin."""
        folded, start, end, owner = self._spans(data, words_of(data, offsets))
        keys, first, which = np.unique(span_hashes(folded, start, end), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, keys)
        new = np.flatnonzero(np.append(self.known, ~keys[-1:])[at] != keys)
        if len(new):
            raw = folded.tobytes()
            self._learn(keys[new], [raw[a:b].decode() for a, b in zip(start[first[new]], end[first[new]], strict=True)])
        slot = self.slots[np.searchsorted(self.known, keys)][which]
        count = self.counts[slot]
        edges = np.concatenate([[0], np.cumsum(count)])
        n = len(offsets) - 1
        ids = np.full(int(edges[-1]) + n, END_OF_TEXT, dtype=np.uint32)
        if len(slot):
            at = np.arange(edges[-1])
            ids[at + np.repeat(owner, count)] = self.ids[at + np.repeat(self.begins[slot] - edges[:-1], count)]
        return ids, edges[np.searchsorted(owner, np.arange(n + 1))] + np.arange(n + 1)


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """One coder for each Python worker."""
    return WordCoder(path)


def fill(space: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to space, not above.

    lengths in the order in which they are tried. Stops as soon as nothing is
    left over.
    """
    mask = (1 << (space + 1)) - 1
    full = 1 << space
    reach, steps = 1, []
    for length in lengths:
        if length > space:
            continue
        left, take = min(counts[length], space // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
            if reach & full:
                break
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def bins(lengths: np.ndarray, capacity: int = CAPACITY) -> Iterator[list[int]]:
    """Indices of the pieces of each sequence."""
    order = np.argsort(-lengths, kind="stable")
    stacks: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        stacks.setdefault(int(lengths[i]), []).append(i)
    counts = {length: len(s) for length, s in stacks.items()}
    open_lengths = sorted(stacks, reverse=True)
    while open_lengths:
        longest = open_lengths[0]
        taken = [stacks[longest].pop()]
        counts[longest] -= 1
        rest = capacity - longest
        if rest:
            for length, n in fill(rest, [x for x in open_lengths if counts[x]], counts).items():
                counts[length] -= n
                taken += [stacks[length].pop() for _ in range(n)]
        if any(not counts[x] for x in {int(lengths[i]) for i in taken}):
            open_lengths = [x for x in open_lengths if counts[x]]
        yield taken


def _pack(path: str, capacity: int, with_ids: bool):
    def each(batches):
        docs: list = []
        parts: list[tuple] = []
        held: list[np.ndarray] = []
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in chunks(batch.column("text")):
                ids, begins = coder(path).encode(data, offsets)
                raw = memoryview(ids.astype("<u4").tobytes())
                for i in range(hi - lo):
                    a, b = int(begins[i]), int(begins[i + 1])
                    for at in range(a, b, capacity):
                        end = min(at + capacity, b)
                        parts.append((len(docs), at - a, end - at, zlib.crc32(raw[4 * at : 4 * end]), b - a))
                        if with_ids:
                            held.append(ids[at:end].astype(np.uint16 if ids[at:end].max() < 65536 else np.uint32))
                    docs.append(ids_of[lo + i])
        if not parts:
            return
        owner, start, length, crc, total = (np.array(x, dtype=np.int64) for x in zip(*parts, strict=True))
        sequence, offset = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        first = TaskContext.get().partitionId() << 33
        order: list[int] = []
        for k, members in enumerate(bins(length, capacity)):
            sequence[members] = first + k
            offset[members] = np.cumsum(length[members]) - length[members]
            order += members
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for lo in range(0, len(order), 2000):
            pick = order[lo : lo + 2000]
            columns = [pa.array([docs[owner[i]] for i in pick], pa.int64())]
            columns += [pa.array(x[pick]) for x in (start, length, crc, total, sequence, offset)]
            if with_ids:
                edges = np.concatenate([[0], np.cumsum(length[pick])]).astype(np.int32)
                flat = np.concatenate([held[i] for i in pick]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids"] if with_ids else names)

    return each


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: its document and place there, its sequence and place there, its ids.

    NULL and empty texts are a single END_OF_TEXT. Each row of docs is packed for
    itself, repeated ones and those without doc_id too. Offsets in a sequence
    follow one another from 0; sequence numbers are unique and stay the same when
    a task runs again, but have gaps. with_ids=False leaves the ids out and keeps
    their checksum.
    """
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return own.mapInArrow(
        _pack(tokenizer_path(tokenizer), capacity, with_ids), _PIECES + (", ids array<int>" if with_ids else "")
    )


def op9_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
