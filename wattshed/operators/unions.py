"""Unions, from strict to forgiving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_position(frames: list[DataFrame]) -> DataFrame:
    """Columns matched by place, duplicates kept; types must agree, nothing widens silently."""
    kinds = [[f.dataType for f in df.schema.fields] for df in frames]
    if any(k != kinds[0] for k in kinds):
        raise ValueError("column types differ by position")
    return reduce(DataFrame.union, frames)


def union_filling(frames: list[DataFrame]) -> DataFrame:
    """Columns matched by name; a column an input lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_strict(frames: list[DataFrame]) -> DataFrame:
    """An error when names or types differ."""
    shape = [(f.name, f.dataType) for f in frames[0].schema.fields]
    for df in frames[1:]:
        if [(f.name, f.dataType) for f in df.schema.fields] != shape:
            raise ValueError("schemas differ")
    return reduce(DataFrame.union, frames)


def union_with_id(frames: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """Union by name with a column that says which input a row came from."""
    return union_filling([df.withColumn(name, F.lit(key)) for key, df in frames.items()])
