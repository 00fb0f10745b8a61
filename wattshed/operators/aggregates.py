"""Grouped totals in three NULL modes, shares, weighted means, totals rows, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ColumnLike, col


def total(c: ColumnLike, nulls: str = "null") -> Column:
    """Sum of a group.

    ``zero``: NULLs ignored, an all-NULL group is 0. ``null``: NULLs ignored, an
    all-NULL group is NULL. ``poison``: one NULL makes the group NULL.
    """
    x = col(c)
    if nulls == "zero":
        return F.coalesce(F.sum(x), F.lit(0))
    if nulls == "null":
        return F.sum(x)
    if nulls == "poison":
        return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))
    raise ValueError("nulls must be 'zero', 'null' or 'poison'")


def total_of_columns(names: list[str], nulls: str = "null") -> Column:
    """Sum of a group over many columns: each is summed by itself, and no row is unpivoted.

    ``nulls``: as for ``total``, without 'poison'.
    """
    sums = [F.sum(c) for c in names]
    whole = F.coalesce(sums[0], F.lit(0))
    for s in sums[1:]:
        whole = whole + F.coalesce(s, F.lit(0))
    if nulls == "zero":
        return whole
    if nulls == "null":
        return F.when(F.coalesce(*sums).isNotNull(), whole)
    raise ValueError("nulls must be 'zero' or 'null'")


def share_of_total(df: DataFrame, value: str, share: str = "share", scale: float = 1) -> DataFrame:
    """Each row's part of the column's overall sum.

    The sum is a scalar subquery, so no row moves for it.
    """
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(share, F.try_divide(F.col(value) * scale, whole))


def share_within(
    df: DataFrame, value: str, by: list[str], share: str = "share", scale: float = 100
) -> DataFrame:
    """Each row's part of its group's sum.

    Group sums are partial aggregates joined back on the group key, so that one
    huge group is split by the skew join instead of meeting in one window task.
    NULL keys form a group, as in a grouping.
    """
    sums = df.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.sum(value).alias("_sum"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    joined = df.join(sums, same, "left")
    return joined.withColumn(share, F.try_divide(F.col(value) * scale, F.col("_sum"))).drop(
        "_sum", *[f"_{k}" for k in by]
    )


def weighted_mean(
    df: DataFrame, rate: str, weight: str, out: str = "weighted", require_rate: bool = False
) -> DataFrame:
    """Rate in percent, weighted; rows without a weight count for nothing.

    A row with a weight and no rate still counts in the denominator, unless
    ``require_rate``.
    """
    w = F.when(F.col(rate).isNotNull(), F.col(weight)) if require_rate else F.col(weight)
    return df.agg(
        F.try_divide(F.sum(F.col(rate) / 100 * F.col(weight)) * 100, F.sum(w)).alias(out)
    )


def with_totals_row(df: DataFrame, label: str, text: str = "Total") -> DataFrame:
    """Append one row of sums of the numeric columns; other columns hold ``text`` or NULL.

    A summed column takes the type of its sum in every row, so that no total
    overflows the type of its parts.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    row = df.agg(
        *[
            F.sum(c).alias(c)
            if c in numeric
            else F.lit(text if c == label else None).cast(df.schema[c].dataType).alias(c)
            for c in df.columns
        ]
    )
    wide = df.select(*[F.col(c).cast(row.schema[c].dataType).alias(c) for c in df.columns])
    return wide.unionByName(row)


def sum_columns(df: DataFrame, by: list[str], names: list[str], nulls: str = "zero") -> DataFrame:
    """The sum of many columns in one pass."""
    return df.groupBy(*by).agg(*[total(c, nulls).alias(c) for c in names])


def profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs and whether all values are missing, for every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select("_rows", F.inline(entries)).select(
        "column",
        F.col("_rows").alias("row_count"),
        "nulls",
        (F.col("nulls") == F.col("_rows")).alias("all_missing"),
    )


def profile_by(df: DataFrame, period: str | Column, names: list[str] | None = None) -> DataFrame:
    """(period, column, row_count, nulls, seen): a profile of each period, to be kept and united later.

    ``seen`` is a theta sketch of the column's values. One pass with partial sums,
    so what is shuffled is a row for each period of a task.
    """
    names = df.columns if names is None else names
    key = (F.col(f"`{period}`") if isinstance(period, str) else period).alias("period")
    sums = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(names):
        held = F.col(f"`{c}`")
        sums += [F.count_if(held.isNull()).alias(f"_n{i}"), F.theta_sketch_agg(held.cast("string")).alias(f"_s{i}")]
    entries = [
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("nulls"), F.col(f"_s{i}").alias("seen"))
        for i, c in enumerate(names)
    ]
    return df.groupBy(key).agg(*sums).select("period", F.inline(F.array(*entries)))


def unite_profiles(*profiles: DataFrame) -> DataFrame:
    """One row for each column: rows, NULLs, whether all are missing, distinct values and the periods it came in.

    Profiles of parts unite to that of the whole: a theta sketch holds the least
    hashes, whichever part they came from. Up to 4,096 distinct values are counted
    exactly; the periods always are.
    """
    held = profiles[0]
    for more in profiles[1:]:
        held = held.unionByName(more)
    united = held.groupBy("column").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("nulls").alias("nulls"),
        F.theta_sketch_estimate(F.theta_union_agg("seen")).alias("distinct"),
        F.array_sort(F.collect_set("period")).alias("periods"),
    )
    return united.withColumn("all_missing", F.col("nulls") == F.col("row_count"))


def frequent_by(df: DataFrame, period: str | Column, names: list[str], most: int = 20) -> DataFrame:
    """(period, column, value, n, given): values that hold more than one in ``most`` of a period's given values.

    Values are text; a period that has none of a column is left out. At most
    ``most`` rows for each period and column.
    """
    key = (F.col(f"`{period}`") if isinstance(period, str) else period).alias("period")
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])
    long = df.select(key, F.inline(entries)).where("value is not null")
    counts = long.groupBy("period", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    given = counts.groupBy("period", "column").agg(F.sum("n").alias("given"))
    same = (F.col("c.column") == F.col("g.column")) & F.col("c.period").eqNullSafe(F.col("g.period"))
    kept = counts.alias("c").join(given.alias("g"), same).where(F.col("n") * most > F.col("given"))
    # A period without a frequent value still says how many there were.
    rest = given.withColumns({"value": F.lit(None).cast("string"), "n": F.lit(0).cast("bigint")})
    return kept.select("c.period", "c.column", "value", "n", "given").unionByName(
        rest.select("period", "column", "value", "n", "given")
    )


def unite_frequent(*parts: DataFrame, most: int = 20) -> DataFrame:
    """(column, value, at_least, at_most): every value that may hold more than one in ``most`` of all values.

    A value that no period kept cannot: it has at most that share everywhere. Where
    a period did not keep a value, it may have had up to its share of one in ``most``.
    """
    held = parts[0]
    for more in parts[1:]:
        held = held.unionByName(more)
    whole = held.where("value is null").groupBy("column").agg(
        F.sum("given").alias("given"), F.sum(F.floor(F.col("given") / most)).alias("_unseen")
    )
    values = held.where("value is not null").groupBy("column", "value").agg(
        F.sum("n").alias("at_least"), F.sum(F.floor(F.col("given") / most)).alias("_seen")
    )
    bounded = values.join(whole, "column").withColumn("at_most", F.col("at_least") + F.col("_unseen") - F.col("_seen"))
    return bounded.where(F.col("at_most") * most > F.col("given")).select("column", "value", "at_least", "at_most")


def value_counts(df: DataFrame, *names: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def run_summary(df: DataFrame, day: str, unit: str, quantity: str) -> DataFrame:
    """Records, first and last day, number of units and total quantity, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_distinct(unit).alias("units"),
        F.coalesce(F.sum(quantity), F.lit(0.0)).alias("total_quantity"),
    )


def only_one(df: DataFrame, key: str, out: str = "single") -> DataFrame:
    """Whether the column holds exactly one distinct value: its least equals its greatest."""
    return df.agg(F.coalesce(F.min(key) == F.max(key), F.lit(False)).alias(out))


def ratio_percent(part: DataFrame, part_value: str, rest: DataFrame, rest_value: str) -> Column:
    """part x 100 / (part + rest), from two one-row sums."""
    p, r = part.agg(F.sum(part_value)).scalar(), rest.agg(F.sum(rest_value)).scalar()
    return F.try_divide(p * 100, p + r)
