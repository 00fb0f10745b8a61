"""Counts of each text that quality rules look at, on whole chunks of bytes at once."""

from __future__ import annotations

import numpy as np

from wattshed.llm.words import mix, span_hashes, windows, words_of

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[ord("A") : ord("Z") + 1] = True
LETTER = UPPER.copy()
LETTER[ord("a") : ord("z") + 1] = True
#: The counts, in the order of their columns.
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_shouts",
]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes in each text."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def seen_before(keys: np.ndarray) -> np.ndarray:
    """Flags of all but the first of equal keys."""
    again = np.ones(len(keys), dtype=bool)
    again[np.unique(keys, return_index=True)[1]] = False
    return again


def keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes told apart by the text that holds them."""
    return mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))


def repeated_words(words, hashes: np.ndarray) -> np.ndarray:
    """Flags of words inside a three-word window that its text holds twice or more."""
    at, grams = windows(words, hashes, 3)
    _, which, count = np.unique(keyed(grams, words.owner[at]), return_inverse=True, return_counts=True)
    hit = at[count[which] > 1]
    flags = np.zeros(len(hashes), dtype=bool)
    for step in range(3):
        flags[hit + step] = True
    return flags


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each text of a chunk, as an array of one row a text."""
    n = len(offsets) - 1
    words = words_of(data, offsets)
    hashes = words.hashes()
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[words.start] = 1
    inside[words.end] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    breaks = np.flatnonzero(data == 10)
    cut[breaks + 1] = True
    begin = np.flatnonzero(cut[: len(data)])
    end = np.append(begin[1:], len(data))[: len(begin)]
    end = end - (data[end - 1] == 10) if len(begin) else end
    held = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    begin, end = begin[held], end[held]
    owner = np.searchsorted(offsets, begin, side="right") - 1
    again = seen_before(keyed(span_hashes(data, begin, end), owner))
    tally = lambda owners: np.bincount(owners, minlength=n)
    return np.stack(
        [
            np.diff(words.first),
            per_text(inside & ((data & 0xC0) != 0x80), offsets),
            per_text(SYMBOL[data], offsets),
            tally(owner[again]),
            tally(words.owner[repeated_words(words, hashes)]),
            tally(owner),
            per_text(UPPER[data], offsets),
            per_text(LETTER[data], offsets),
            per_text(data == ord("!"), offsets),
        ],
        axis=1,
    )
