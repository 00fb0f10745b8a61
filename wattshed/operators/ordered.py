"""Whole-table order without a whole-table task.

Row numbers, running sums and previous values over all rows need a global order,
which a window without partitions would do in a single task. Here Spark's range
partitioning deals the rows to tasks in key order and each task sorts its own.
The rows, with the number of their part and their place in it, are written once
under the cluster's checkpoint folder: the input is read once, and a task that
runs again sees the same parts. One row for each part then carries what the
next ones need. Keys must be unique, as they are after a distinct or a grouping;
add a tie-breaker if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_folder

_PART, _PLACE = "_part", "_place"
#: Low bits of Spark's increasing row number, which count the rows of a part.
_ROW_BITS = 33


def ranged(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """df with ``_part`` and ``_place`` from 0, both in key order, written and read again.

    ``parts``: how many; by default the session's number of shuffle partitions.
    """
    dealt = df.repartitionByRange(*([parts] if parts else []), *[F.col(k) for k in keys])
    placed = dealt.sortWithinPartitions(*keys).withColumns(
        {
            _PART: F.spark_partition_id(),
            _PLACE: F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1),
        }
    )
    path = scratch_folder(df.sparkSession, "ordered")
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def _before(rows: DataFrame, carried: Column) -> DataFrame:
    """What each part takes over from those before it; one row for each part."""
    summed = rows.groupBy(_PART).agg(carried.alias("_c"))
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return summed.select(_PART, F.sum("_c").over(earlier).alias("_before"))


def row_ids(df: DataFrame, keys: list[str], out: str = "id", parts: int | None = None) -> DataFrame:
    """1..n in key order."""
    rows = ranged(df, keys, parts)
    joined = rows.join(_before(rows, F.count(F.lit(1))), _PART)
    numbered = joined.withColumn(out, F.col(_PLACE) + F.coalesce("_before", F.lit(0)) + 1)
    return numbered.select(*df.columns, out)


def running_total(
    df: DataFrame, keys: list[str], value: str, out: str = "running", parts: int | None = None
) -> DataFrame:
    """Sum of all rows up to this one, in key order."""
    rows = ranged(df, keys, parts)
    joined = rows.join(_before(rows, F.sum(value)), _PART)
    here = F.sum(value).over(
        W.partitionBy(_PART).orderBy(_PLACE).rowsBetween(W.unboundedPreceding, 0)
    )
    summed = joined.withColumn(out, here + F.coalesce("_before", F.lit(0)))
    return summed.select(*df.columns, out)


def previous_value(
    df: DataFrame, keys: list[str], value: str, out: str = "previous", parts: int | None = None
) -> DataFrame:
    """The value of the row before this one, in key order."""
    rows = ranged(df, keys, parts)
    last = rows.groupBy(_PART).agg(F.max_by(F.struct(value), _PLACE).alias("_l"))
    carried = last.select(_PART, F.lag("_l").over(W.orderBy(_PART)).alias("_l"))
    inner = F.lag(value).over(W.partitionBy(_PART).orderBy(_PLACE))
    joined = rows.join(carried, _PART)
    lagged = joined.withColumn(out, F.when(F.col(_PLACE) == 0, F.col("_l")[value]).otherwise(inner))
    return lagged.select(*df.columns, out)


def display_midpoint(df: DataFrame, keys: list[str], value: str, out: str = "midpoint") -> DataFrame:
    """Running sum less half the row's own value: where a stacked bar's label goes.

    For the handful of rows of one chart, so a plain window does.
    """
    w = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w) - F.col(value) * 0.5)


def with_change(
    df: DataFrame, period: str, value: str, by: list[str] | None = None
) -> DataFrame:
    """Change and percent change on the period before.

    For totals with one row for each period, or each group and period: a window
    then holds no more rows than the calendar has periods. For a change from row
    to row of a large table, use ``previous_value``.
    """
    w = W.partitionBy(*by).orderBy(period) if by else W.orderBy(period)
    before = F.lag(value).over(w)
    return df.withColumns(
        {
            "change": F.col(value) - before,
            "pct_change": F.try_divide((F.col(value) - before) * 100, before),
        }
    )


def batches(
    df: DataFrame, keys: list[str], size: int = 100, out: str = "batch", parts: int | None = None
) -> DataFrame:
    """Number the rows in key order and put each ``size`` of them in one batch, from 0."""
    numbered = row_ids(df, keys, "id", parts)
    return numbered.withColumn(out, F.floor((F.col("id") - 1) / size).cast("long"))
