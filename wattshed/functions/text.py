"""Text functions on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for an expression that uses it many times.

    As a plain column the value would be written out, and may be worked out, at
    each use; a lambda's variable is worked out once for each row.
    """
    return F.transform(F.array(value), body)[0]


def char_slice(c: ColumnLike, first: int, last: int | None = None) -> Column:
    """Characters ``first``..``last``, both counted from 1 and inclusive; 0 counts as 1."""
    first = max(first, 1)
    length = F.lit(2**31 - 1 if last is None else max(last - first + 1, 0))
    return F.substring(col(c), F.lit(first), length)


def sentence_case(c: ColumnLike, lower_rest: bool = False) -> Column:
    """First letter upper case and underscores to spaces; the rest as it was, or lowered."""
    spaced = F.replace(col(c), F.lit("_"), F.lit(" "))
    rest = char_slice(spaced, 2)
    return F.concat(F.upper(char_slice(spaced, 1, 1)), F.lower(rest) if lower_rest else rest)


def replace_first(c: ColumnLike, search: str, replacement: str) -> Column:
    """Replace only the first occurrence of a literal."""
    at = F.locate(search, col(c))
    head = F.substring(col(c), F.lit(1), at - 1)
    tail = F.substring(col(c), at + len(search), F.lit(2**31 - 1))
    return F.when(at > 0, F.concat(head, F.lit(replacement), tail)).otherwise(col(c))


def regex_or_null(c: ColumnLike, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``; NULL, not an empty string, when nothing matches."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def squish(c: ColumnLike) -> Column:
    """Trim, and collapse inner runs of white space to one space."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def plain_words(c: ColumnLike) -> Column:
    """Keep letters, digits and colons; all between them, white space too, is one space."""
    return F.trim(F.regexp_replace(col(c), r"[^a-zA-Z0-9:]+", " "))


def strip_note(c: ColumnLike) -> Column:
    """Cut a trailing ``_note...`` from a name held as data."""
    return F.regexp_replace(col(c), r"_note.*", "")
