"""Column names and column sets. Everything here touches metadata only."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NameStyle:
    """How a header becomes a column name.

    Characters that are part of a word stay; white space, or with ``split_all`` any
    other character, parts words; what is left is dropped. Words are joined by
    an underscore. ``edge_left`` and ``edge_right`` keep a join where the header
    starts or ends with a parting character.
    """

    punctuation: bool = False  # part of a word
    split_all: bool = False
    edge_left: bool = False
    edge_right: bool = False
    digit_mark: bool = False  # an underscore before a leading digit
    cut_note: str = ""  # "raw": the header, "name": the finished name, from "_note" on

    def _in_word(self, ch: str) -> bool:
        if self.split_all:
            return ch.isascii() and ch.isalnum()
        return ch.isalnum() or ch == "_" or (self.punctuation and not ch.isspace())

    def __call__(self, header: str) -> str:
        note = header.find("_note")
        if self.cut_note == "raw" and 0 <= note < len(header) - len("_note"):
            header = header[:note]
        words, open_word, parted = [""], False, []
        for ch in header:
            if self._in_word(ch):
                if not open_word and words[-1]:
                    words.append("")
                words[-1] += ch.lower()
                open_word = True
            elif self.split_all or ch.isspace():
                open_word = False
            parted.append(not self._in_word(ch) and (self.split_all or ch.isspace()))
        name = "_".join(words)
        if parted and self.edge_left and parted[0]:
            name = f"_{name}"
        if len(parted) > 1 and self.edge_right and parted[-1]:
            name = f"{name}_"
        if self.cut_note == "name":
            name = name.partition("_note")[0]
        return f"_{name}" if self.digit_mark and name[:1].isdigit() else name


plain_name = NameStyle(digit_mark=True)
cut_note_name = NameStyle(edge_left=True, edge_right=True, cut_note="name")
keep_punctuation_name = NameStyle(punctuation=True, cut_note="raw")
underscore_name = NameStyle(split_all=True, edge_left=True)

NAME_STYLES: dict[str, NameStyle] = {
    "plain": plain_name,
    "cut_note": cut_note_name,
    "keep_punctuation": keep_punctuation_name,
    "underscore": underscore_name,
}


def numbered_repeats(names: list[str]) -> list[str]:
    """The names, with ``_1``, ``_2``... behind those that an earlier one has taken, whatever the case."""
    taken: set[str] = set()
    out = []
    for name in names:
        own, n = name, 0
        while own.lower() in taken:
            n += 1
            own = f"{name}_{n}"
        taken.add(own.lower())
        out.append(own)
    return out


def normalise_columns(df: DataFrame, style: str = "plain") -> DataFrame:
    """Headers as names; headers that come to the same name are numbered."""
    rename = NAME_STYLES[style]
    return df.toDF(*numbered_repeats([rename(c) for c in df.columns]))


def rename_removing(df: DataFrame, pattern: str) -> DataFrame:
    """Remove the first match of ``pattern`` from every name."""
    return df.toDF(*[re.sub(pattern, "", c, count=1) for c in df.columns])


def matching(df: DataFrame, test: Callable[[str], object]) -> list[str]:
    return [c for c in df.columns if test(c)]


def starting(df: DataFrame, prefix: str) -> list[str]:
    return matching(df, lambda c: c.lower().startswith(prefix.lower()))


def ending(df: DataFrame, suffix: str) -> list[str]:
    return matching(df, lambda c: c.lower().endswith(suffix.lower()))


def containing(df: DataFrame, token: str) -> list[str]:
    return matching(df, lambda c: token.lower() in c.lower())


def select_renamed(df: DataFrame, pattern: str, replacement: str = r"\1") -> DataFrame:
    """Only the columns that match, each renamed from the pattern's groups."""
    hits = matching(df, lambda c: re.search(pattern, c))
    return df.select([F.col(f"`{c}`").alias(re.sub(pattern, replacement, c)) for c in hits])


def without_notes(name: str) -> str:
    """The name less the notes at its end, each ``note_`` and digits."""
    while True:
        head = name.rstrip("0123456789")
        if head == name or not head.endswith("note_"):
            return name
        name = head.removesuffix("note_").removesuffix("_")


def strip_note_suffixes(df: DataFrame) -> DataFrame:
    """Noted columns under their bare names first, then every column without a note."""
    noted = [c for c in df.columns if without_notes(c) != c]
    bare = [c for c in df.columns if "_note" not in c]
    picked = [F.col(f"`{c}`").alias(without_notes(c)) for c in noted]
    return df.select(picked + [F.col(f"`{c}`") for c in bare])


def without(df: DataFrame, *names: str) -> DataFrame:
    """All columns but the named ones; a name that is not there is an error."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.drop(*names)


def replaced(df: DataFrame, **expressions: Column) -> DataFrame:
    """All columns in place, some with new expressions; new names are an error."""
    missing = set(expressions) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.withColumns(expressions)


def first_columns(df: DataFrame, *names: str) -> DataFrame:
    """Named columns first, the rest after them in their old order."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def apply_to(df: DataFrame, names: Iterable[str], fn: Callable[[str], Column]) -> DataFrame:
    """One function over many columns, by name."""
    return df.withColumns({c: fn(c) for c in names})


def positional_names(df: DataFrame, *leading: str) -> DataFrame:
    """Rename the first columns; number the others ``col_0``, ``col_1``..."""
    rest = [f"col_{i}" for i in range(len(df.columns) - len(leading))]
    return df.toDF(*leading, *rest)
