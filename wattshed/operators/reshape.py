"""Wide to long and back, and splitting delimited text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ColumnLike, col
from ..session import scratch_folder


def to_long(
    df: DataFrame,
    ids: list[str],
    name: str = "name",
    value: str = "value",
    columns: list[str] | None = None,
    keep_nulls: bool = False,
) -> DataFrame:
    """One row for each value column. NULL cells go unless ``keep_nulls``.

    Value columns of several types become text first, as a long column has one type.
    """
    names = columns if columns is not None else [c for c in df.columns if c not in ids]
    kinds = {df.schema[c].dataType for c in names}
    if len(kinds) > 1:
        df = df.withColumns({c: F.col(c).cast("string") for c in names})
    long = df.unpivot(ids, names, name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def to_long_matching(
    df: DataFrame, pattern: str, name: str = "name", value: str = "value", keep_nulls: bool = False
) -> DataFrame:
    """Unpivot the columns that match; the others ride along."""
    hits = [c for c in df.columns if re.search(pattern, c)]
    ids = [c for c in df.columns if c not in hits]
    return to_long(df, ids, name, value, hits, keep_nulls)


def pivot_sum(df: DataFrame, by: list[str], key: str, value: str, values: list) -> DataFrame:
    """One summed column for each given key; naming the keys saves a pass to find them."""
    return df.groupBy(*by).pivot(key, values).agg(F.sum(value))


def pivot_map(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """One row for each group, with ``totals``, the sum of value by key, for whatever keys there are.

    Sums are partial before they are shuffled; a map holds one entry for each key.
    Rows without key are left out, as no column could be named for them.
    """
    sums = df.where(F.col(key).isNotNull()).groupBy(*by, key).agg(F.sum(value).alias("_total"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), F.col("_total").alias("value"))))
    return sums.groupBy(*by).agg(F.map_from_entries(entries).alias("totals"))


def pivot_found(df: DataFrame, by: list[str], key: str, value: str, most: int = 2_000) -> DataFrame:
    """One summed column for each key that the data have, in order of the keys.

    The input is read once: its sums are written under the checkpoint folder, and
    the keys and the wide rows are taken from these. More keys than ``most`` are an
    error, since each becomes a column.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "pivot")
    pivot_map(df, by, key, value).write.parquet(path)
    summed = spark.read.parquet(path)
    keys = summed.select(F.explode(F.map_keys("totals")).alias("k")).distinct().orderBy("k").limit(most + 1)
    found = [r["k"] for r in keys.collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {key}: pass the ones wanted to pivot_sum")
    return summed.select(*by, *[F.col("totals")[k].alias(str(k)) for k in found])


def split_in_two(df: DataFrame, c: str, delimiter: str, first: str, second: str) -> DataFrame:
    """Split at the first delimiter only; text without one has a NULL second part."""
    parts = F.split(F.col(c), re.escape(delimiter), 2)
    return df.withColumns({first: F.get(parts, F.lit(0)), second: F.get(parts, F.lit(1))})


def lines(c: ColumnLike) -> Column:
    """One row for each non-empty line."""
    return F.explode(F.filter(F.split(col(c), "\n"), lambda x: F.length(x) > 0))
