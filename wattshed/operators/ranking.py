"""Sort orders, top rows and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, col


def list_position(c: ColumnLike, order: list[str]) -> Column:
    """Place in a given list, from 1; NULL when not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), col(c)), F.lit(0))


def arrange(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Ascending, missing values last."""
    return df.orderBy(*[F.asc_nulls_last(k) if isinstance(k, str) else k for k in keys])


def arrange_by_list(df: DataFrame, c: str, order: list[str]) -> DataFrame:
    """By place in a list; unlisted values last, by name."""
    return df.orderBy(list_position(c, order).asc_nulls_last(), F.asc_nulls_last(c))


def top(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with the greatest keys; each task keeps n rows, and no full sort runs."""
    return df.orderBy(*[F.desc_nulls_last(k) for k in keys]).limit(n)


def bottom(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n rows with the least keys; rows with missing keys come after all others."""
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(n)


def tail(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The last n rows of a descending order that ends in its missing keys."""
    return df.orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(n)


def repeatable_sample(df: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """n rows at random, by a digest of the key.

    The same seed gives the same rows however the data is partitioned, also when
    a lost task runs again. The keys must identify a row.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(digest, *keys).limit(n)
