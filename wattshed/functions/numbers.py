"""Casts that survive suppression markers, rounding in both styles, units and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, col

# GWh per kilotonne of oil equivalent, and the scale steps.
GWH_PER_KTOE = 11.63
MWH_PER_GWH = 1000
KT_PER_MT = 1000


def half_away_int(c: ColumnLike) -> Column:
    """Decimal text or number to INTEGER, halves away from zero."""
    return F.round(col(c).cast("double")).cast("int")


def marker_to_null(c: ColumnLike) -> Column:
    """Cells that start with ``[`` are suppression markers and become NULL."""
    return F.when(~col(c).startswith("["), col(c))


def marker_cast(c: ColumnLike, to: str = "double") -> Column:
    """Marker to NULL, then a hard cast: other bad text fails the query."""
    kept = marker_to_null(c)
    return half_away_int(kept) if to == "int" else kept.cast(to)


def lenient_cast(c: ColumnLike, to: str = "double") -> Column:
    """Anything that is not a number becomes NULL, also a number with a type letter such as ``1d``."""
    lettered = col(c).cast("string").rlike("(?i)[0-9.][dfl]\\s*$")
    return F.when(~lettered, col(c).try_cast(to))


def round_half_even(c: ColumnLike, digits: int = 0) -> Column:
    return F.bround(col(c), digits)


def round_half_away(c: ColumnLike, digits: int = 0) -> Column:
    return F.round(col(c), digits)


def ktoe_to_gwh(c: ColumnLike) -> Column:
    return col(c) * GWH_PER_KTOE


def mwh_to_gwh(c: ColumnLike) -> Column:
    return col(c) / MWH_PER_GWH


def kt_to_mt(c: ColumnLike) -> Column:
    return col(c) / KT_PER_MT


def percent_change(old: ColumnLike, new: ColumnLike, base: str = "old") -> Column:
    """Change in percent of the old value, or of the new one with ``base='new'``."""
    if base not in ("old", "new"):
        raise ValueError("base must be 'old' or 'new'")
    below = col(old) if base == "old" else col(new)
    return F.try_divide((col(new) - col(old)) * 100, below)


def absolute_gap(a: ColumnLike, b: ColumnLike) -> Column:
    return F.abs(col(a) - col(b))


def zero_if_null(c: ColumnLike) -> Column:
    return F.coalesce(col(c), F.lit(0))


def main_or_other(c: ColumnLike, main: list[str], other: str = "Other") -> Column:
    """Keep the named classes and pool every other value, NULL included, under ``other``."""
    return F.when(col(c).isin(main), col(c)).otherwise(other)


def correct_sentinel(c: ColumnLike, sentinel: int, value: int) -> Column:
    return F.when(col(c) == sentinel, F.lit(value)).otherwise(col(c))
