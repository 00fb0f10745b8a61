"""Predicates whose NULL behaviour matters, and slices by period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, col

ENGLISH_AUTHORITY = "E0"


def english_authorities(df: DataFrame, code: str = "code", anywhere: bool = False) -> DataFrame:
    """Keep authority codes that start with E0, or hold it anywhere."""
    c = F.col(code)
    return df.where(c.contains(ENGLISH_AUTHORITY) if anywhere else c.startswith(ENGLISH_AUTHORITY))


def not_in_or_null(c: ColumnLike, values: list) -> Column:
    """Not one of the values; a missing value passes."""
    return col(c).isNull() | ~col(c).isin(values)


def include_exclude(c: ColumnLike, include: str, exclude: str) -> Column:
    return col(c).rlike(include) & ~col(c).rlike(exclude)


def members_of(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in a column of another table."""
    keys = other.select(F.col(other_key or key).alias(key)).distinct()
    return df.join(keys, key, "left_semi")


def latest_slice(df: DataFrame, period: str, of: DataFrame | None = None) -> DataFrame:
    """Rows of the latest period of this table, or of ``of``.

    The maximum is a scalar subquery: it runs once over one column and reaches
    the scan as a plain filter value, with no join.
    """
    latest = (df if of is None else of).agg(F.max(period)).scalar()
    return df.where(F.col(period) == latest)


def trailing_slice(df: DataFrame, period: str, back: int, of: DataFrame | None = None) -> DataFrame:
    """Rows whose period is at least the latest one minus ``back``."""
    start = (df if of is None else of).agg(F.max(period) - back).scalar()
    return df.where(F.col(period) >= start)


def first_and_last_slice(df: DataFrame, period: str, of: DataFrame | None = None) -> DataFrame:
    """Rows of the earliest and of the latest period."""
    base = df if of is None else of
    low, high = base.agg(F.min(period)).scalar(), base.agg(F.max(period)).scalar()
    return df.where((F.col(period) == low) | (F.col(period) == high))
