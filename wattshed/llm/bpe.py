"""Byte-pair encoding by dynamic programming over prefixes, on many words at once.

The encoding of a prefix ends in exactly one token, and dropping that token
leaves the encoding of the shorter prefix. So it is enough to store, for each
prefix of a word, its last token: of the vocabulary's tokens that end there (found
by following all places of all words through the vocabulary's automaton), the one
that can stand next to the last token of the prefix before it. Two tokens can
stand together if merging them back in order of rank never joins bytes across
their border. Back-pointers then give the ids. Each step runs on arrays over all
words, and each distinct word of a task is encoded once.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Tokenizer

from wattshed.llm.common import free_name, table, with_struct
from wattshed.llm.words import chunks, span_hashes

TOKENIZER = "byte_bpe_50k.json"
#: Distinct words that a task remembers before it starts afresh.
REMEMBERED = 400_000

LETTER, NUMBER, BLANK, OTHER = range(4)


class Lookup:
    """Whole numbers to whole numbers, open addressing, asked for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            first = np.zeros(len(left), dtype=bool)
            first[np.unique(slot[left], return_index=True)[1]] = True
            put = left[free & first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[~(free & first)]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Vocabulary:
    """Merges of a byte-level vocabulary, in order of rank after the single bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte_of = byte_characters()
        singles = sorted((i for t, i in vocab.items() if len(t) == 1))
        base = len(singles)
        self.bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        ids = {self.bytes[i]: i for i in vocab.values()}
        self.added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        size = len(self.bytes)
        rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        order = np.zeros(size, dtype=np.int64)
        keys = np.zeros(len(merges), dtype=np.int64)
        made = np.zeros(len(merges), dtype=np.int64)
        for i, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = vocab[a], vocab[b]
            c = ids[self.bytes[a] + self.bytes[b]]
            self.left[c], self.right[c], order[c] = a, b, base + i
            keys[i], made[i] = a * size + b, c
        # Work in numbers that grow with the rank; back to ids at the end.
        order[singles] = np.arange(base)
        usable = np.zeros(size, dtype=bool)
        usable[singles] = usable[made] = True
        self.id_of = np.full(base + len(merges), -1, dtype=np.int64)
        self.id_of[order[usable]] = np.flatnonzero(usable)
        n = len(self.id_of)
        first, second = self.left.copy(), self.right.copy()
        self.left, self.right = np.arange(n), np.arange(n)
        known = self.id_of >= 0
        self.left[known], self.right[known] = order[first[self.id_of[known]]], order[second[self.id_of[known]]]
        self.size = n
        self.pairs = Lookup(order[keys // size] * n + order[keys % size], order[made].astype(np.int32))
        self._automaton(known)
        self.single = np.zeros(256, dtype=np.int64)
        for i in singles:
            self.single[self.bytes[i][0]] = order[i]

    def _automaton(self, known: np.ndarray) -> None:
        """States are the prefixes of tokens; moves by byte."""
        states: dict[bytes, int] = {b"": 0}
        token: list[int] = [-1]
        keys, values = [], []
        for number in np.flatnonzero(known):
            word = self.bytes[self.id_of[number]]
            state = 0
            for k in range(1, len(word) + 1):
                nxt = states.get(word[:k])
                if nxt is None:
                    nxt = states[word[:k]] = len(token)
                    token.append(-1)
                    keys.append(state * 256 + word[k - 1])
                    values.append(nxt)
                state = nxt
            token[state] = int(number)
        self.moves = Lookup(np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32))
        self.token = np.array(token, dtype=np.int64)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the encoding of the bytes of tokens a and b is a, b.

        Takes the two apart from the border in reverse order of merging; a pair
        across the border that would have been merged earlier rules them out.
        """
        fits = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        limit = np.full(len(a), self.size + 1)
        while len(at):
            joined = self.pairs.get(a * self.size + b)
            bad = (joined >= 0) & (joined < limit)
            fits[at[bad]] = False
            inner_a, inner_b = self.right[a], self.left[b]
            whole_a, whole_b = inner_a == a, inner_b == b
            by_a = ((a > b) & ~whole_a) | ((a <= b) & whole_b)
            over = whole_a & whole_b
            limit = np.where(by_a, a, b + 1)
            a, b = np.where(by_a, inner_a, a), np.where(by_a, b, inner_b)
            go = ~bad & ~over
            at, a, b, limit = at[go], a[go], b[go], limit[go]
        return fits

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words data[start:end], one after another, and their number for each word."""
        length = end - start
        edges = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(length, out=edges[1:])
        n = int(edges[-1])
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        word = np.repeat(np.arange(len(start)), length)
        flat = data[np.arange(n) - edges[:-1][word] + start[word]].astype(np.int64)
        stop = edges[1:][word]
        heads, tails, tokens = [], [], []
        at, state, step = np.arange(n), np.zeros(n, dtype=np.int64), 0
        while len(at):
            state = self.moves.get(state * 256 + flat[at + step]).astype(np.int64)
            live = state >= 0
            at, state = at[live], state[live]
            found = self.token[state]
            hit = found >= 0
            heads.append(at[hit])
            tails.append(at[hit] + step + 1)
            tokens.append(found[hit])
            step += 1
            more = at + step < stop[at]
            at, state = at[more], state[more]
        head, tail, token = np.concatenate(heads), np.concatenate(tails), np.concatenate(tokens)
        begin = edges[:-1][word[head]]
        reach = tail - begin
        # By prefix, longest token first.
        order = np.lexsort((head, reach))
        head, tail, token, begin, reach = head[order], tail[order], token[order], begin[order], reach[order]
        last, back = np.full(n + 1, -1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        marks = np.append(np.flatnonzero(np.diff(reach, prepend=0)), len(reach))
        for lo, hi in zip(marks[:-1], marks[1:], strict=True):
            h, t, k = head[lo:hi], tail[lo:hi], token[lo:hi]
            fits = h == begin[lo:hi]
            inner = np.flatnonzero(~fits)
            # Where a whole prefix is a token, that is its last one.
            whole = t[fits]
            last[whole], back[whole] = k[fits], h[fits]
            inner = inner[last[t[inner]] < 0]
            good = inner[self.compatible(last[h[inner]], k[inner])]
            good = good[::-1]
            last[t[good]], back[t[good]] = k[good], h[good]
        out, owner, at = [], [], edges[1:][length > 0]
        who = np.flatnonzero(length > 0)
        first = edges[:-1][length > 0]
        while len(at):
            out.append(last[at])
            owner.append(who)
            at = back[at]
            go = at > first
            at, who, first = at[go], who[go], first[go]
        ids, owner = np.concatenate(out[::-1]), np.concatenate(owner[::-1])
        order = np.argsort(owner, kind="stable")
        return self.id_of[ids[order]], np.bincount(owner, minlength=len(start))


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def character_classes(path: str) -> np.ndarray:
    """LETTER, NUMBER, BLANK or OTHER for each code point, as the file's own splitter has it.

    Which letters and numbers there are depends on a library's Unicode version;
    those that the splitter doesn't know are other characters.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for run in regex.finditer(pattern, every):
            lo, hi = ord(run[0][0]), ord(run[0][-1]) + 1
            out[lo:hi] = kind
    splitter = Tokenizer.from_file(path).pre_tokenizer
    for kind, like in ((LETTER, "a"), (NUMBER, "1")):
        points = np.flatnonzero(out == kind)
        parts = splitter.pre_tokenize_str("".join(f"{like}{chr(c)}\n" for c in points))
        one = {begin // 3 for _, (begin, end) in parts if begin % 3 == 0 and end == begin + 2}
        out[np.delete(points, list(one))] = OTHER
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first byte, code point) of each character."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int64)
    padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
    point = lead.copy()
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        a, b = at[wide], lead[wide]
        one, two, three = (padded[a + k].astype(np.int64) & 0x3F for k in (1, 2, 3))
        point[wide] = np.where(
            b < 0xE0,
            (b & 0x1F) << 6 | one,
            np.where(b < 0xF0, (b & 0x0F) << 12 | one << 6 | two, (b & 0x07) << 18 | one << 12 | two << 6 | three),
        )
    return at, point


#: Endings that stay with their apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def pieces(data: np.ndarray, cuts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in bytes of what is encoded by itself, never across one of cuts.

    Runs of letters, of digits or of other characters with one space before
    them; English endings after an apostrophe; the white space left over.
    """
    at, point = code_points(data)
    n = len(at)
    if not n:
        return at, at
    kind = classes[point]
    edge = np.zeros(n + 1, dtype=bool)
    edge[np.searchsorted(at, cuts)] = True
    edge[n] = True
    begin = edge[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    run = begin.copy()
    blank = kind == BLANK
    before = np.flatnonzero(blank[:-1] & ~blank[1:] & ~edge[1:n])
    begin[before] = True
    spaced = before[point[before] == 0x20]
    begin[spaced + 1] = False
    quotes = np.flatnonzero((point == 0x27) & begin)
    quotes = quotes[(quotes + 1 < n)]
    quotes = quotes[run[quotes + 1] & (kind[quotes + 1] == LETTER) & ~edge[quotes + 1]]
    for q in quotes:
        ahead = "".join(map(chr, point[q + 1 : q + 3]))
        if edge[q + 2]:
            ahead = ahead[:1]
        size = next((len(e) for e in ENDINGS if ahead.startswith(e)), 0)
        if size:
            begin[q + 1] = False
            if q + 1 + size < n:
                begin[q + 1 + size] = True
    start = at[begin]
    return start, np.append(start[1:], len(data))


class Encoder:
    """Texts to ids and back, with the ids of words met before kept for a while."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.classes = character_classes(path)
        self.plain: np.ndarray = np.concatenate(
            [np.frombuffer(b, dtype=np.uint8) for b in [*self.vocabulary.bytes, *self.vocabulary.added]]
        )
        top = max([len(self.vocabulary.bytes) - 1, *self.vocabulary.added.values()]) + 1
        sizes = np.zeros(top, dtype=np.int64)
        sizes[: len(self.vocabulary.bytes)] = [len(b) for b in self.vocabulary.bytes]
        for word, i in self.vocabulary.added.items():
            sizes[i] = len(word)
        self.sizes, self.places = sizes, np.zeros(top, dtype=np.int64)
        lengths = [len(b) for b in [*self.vocabulary.bytes, *self.vocabulary.added]]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        self.places[: len(self.vocabulary.bytes)] = begins[: len(self.vocabulary.bytes)]
        for k, i in enumerate(self.vocabulary.added.values()):
            self.places[i] = begins[len(self.vocabulary.bytes) + k]
        self.digits = np.array([list(f"{i},".encode().ljust(8)) for i in range(top)], dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def _specials(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the strings of added tokens inside single texts."""
        raw, found, done = data.tobytes(), [], -1
        if not any(word in raw for word in self.vocabulary.added):
            return []
        pattern = regex.compile(b"|".join(map(regex.escape, self.vocabulary.added)))
        for m in pattern.finditer(raw):
            text = int(np.searchsorted(offsets, m.start(), side="right"))
            if m.end() <= offsets[text] and m.start() > done - 1:
                found.append((m.start(), m.end(), self.vocabulary.added[m[0]]))
                done = m.end()
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray, remember: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, one after another, and where each text's begin."""
        special = self._specials(data, offsets)
        cuts = np.unique(np.concatenate([offsets, [p for s in special for p in s[:2]]]).astype(np.int64))
        start, end = pieces(data, cuts, self.classes)
        fixed = np.full(len(start), -1, dtype=np.int64)
        if special:
            inside = np.searchsorted(start, [s[0] for s in special])
            until = np.searchsorted(start, [s[1] for s in special])
            gone = np.zeros(len(start), dtype=bool)
            for (_, stop, i), lo, hi in zip(special, inside, until, strict=True):
                fixed[lo], end[lo] = i, stop
                gone[lo + 1 : hi] = True
            start, end, fixed = start[~gone], end[~gone], fixed[~gone]
        if remember:
            keys, first, which = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        else:
            first = which = np.arange(len(start))
            keys = np.arange(len(start), dtype=np.uint64)
        if not remember or len(self.slots) + len(keys) > REMEMBERED:
            self.forget()
        new = np.array([k for k, h in enumerate(keys.tolist()) if h not in self.slots], dtype=np.int64)
        if len(new):
            ids, counts = self.vocabulary.encode(data, start[first[new]], end[first[new]])
            self.slots.update(zip(keys[new].tolist(), range(len(self.slots), len(self.slots) + len(new)), strict=True))
            self.ids.append(ids)
            self.counts.append(counts)
            self.all_ids, self.all_counts = np.concatenate(self.ids), np.concatenate(self.counts)
            self.ids, self.counts = [self.all_ids], [self.all_counts]
            self.begins = np.concatenate([[0], np.cumsum(self.all_counts)])
        slot = np.array([self.slots[h] for h in keys.tolist()], dtype=np.int64)[which] if len(start) else first
        if not len(start):
            return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
        count = np.where(fixed >= 0, 1, self.all_counts[slot])
        edges = np.concatenate([[0], np.cumsum(count)])
        ids = self.all_ids[np.repeat(self.begins[slot] - edges[:-1], count).clip(-edges[-1]) + np.arange(edges[-1])]
        ids[edges[:-1][fixed >= 0]] = fixed[fixed >= 0]
        begins = edges[np.searchsorted(start, offsets)]
        if remember and not np.array_equal(self.decode(ids), data):
            return self.encode(data, offsets, remember=False)
        return ids, begins

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        size = self.sizes[ids]
        edges = np.concatenate([[0], np.cumsum(size)])
        return self.plain[np.repeat(self.places[ids] - edges[:-1], size) + np.arange(edges[-1])]

    def decimal(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in digits, a comma behind each, and where the digits of each begin."""
        rows = self.digits[ids]
        shown = rows != 0x20
        return rows[shown], np.concatenate([[0], np.cumsum(shown.sum(axis=1))])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
)
_DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def encoded(docs: DataFrame, text: str = "text", name: str = TOKENIZER) -> tuple[DataFrame, str]:
    """docs with a struct more, and its name: the ids of each text, and the text they decode to.

    NULL and empty texts have no ids. The strings of added tokens become their
    ids. Columns of docs keep their names: the struct takes one that is free.
    """
    return _encoded(docs, text, name, _TOKENS, _token_column)


def encoding_digests(docs: DataFrame, text: str = "text", name: str = TOKENIZER) -> tuple[DataFrame, str]:
    """As encoded(), with the number of ids and the digests of ids and decoded text only."""
    return _encoded(docs, text, name, _DIGESTS, _digest_column)


def _encoded(docs: DataFrame, text: str, name: str, kind: T.StructType, column) -> tuple[DataFrame, str]:
    held = free_name(docs, "tokens")
    path = tokenizer_path(name)
    return with_struct(docs, held, kind, lambda batch: column(encoder(path), batch.column(text))), held


def _token_column(coder: Encoder, texts: pa.Array) -> pa.Array:
    ids, ends, decoded = [np.zeros(0, dtype=np.int32)], [np.zeros(1, dtype=np.int64)], []
    for _, _, data, offsets in chunks(texts):
        found, begins = coder.encode(data, offsets)
        plain = coder.decode(found)
        edges = np.concatenate([[0], np.cumsum(coder.sizes[found])])[begins]
        ids.append(found.astype(np.int32))
        ends.append(begins[1:] + ends[-1][-1])
        decoded += [plain[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(ids)))
    return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.binary()).cast(pa.string())], ["ids", "decoded"])


def _digest_column(coder: Encoder, texts: pa.Array) -> pa.Array:
    numbers, ids_hex, text_hex = [], [], []
    for _, _, data, offsets in chunks(texts):
        ids, begins = coder.encode(data, offsets)
        plain = coder.decode(ids)
        edges = np.concatenate([[0], np.cumsum(coder.sizes[ids])])[begins]
        digits, places = coder.decimal(ids)
        marks = places[begins]
        for i in range(len(offsets) - 1):
            numbers.append(int(begins[i + 1] - begins[i]))
            ids_hex.append(hashlib.sha256(digits[marks[i] : max(marks[i + 1] - 1, marks[i])]).hexdigest())
            text_hex.append(hashlib.sha256(plain[edges[i] : edges[i + 1]]).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
        ["n_tokens", "ids_sha256", "decoded_sha256"],
    )


def op6_bpe_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded, name = encoding_digests(docs)
    return coded.select("doc_id", f"{name}.*")
