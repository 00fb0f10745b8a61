"""The query registry and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The tables of one scale factor, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @cached_property
    def inputs(self):
        from .inputs import Inputs

        return Inputs(self)


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    make: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.make(Tables(spark, folder))


CATALOGUE: dict[str, Query] = {}


def query(name: str, *covers: str, sql: str | None = None):
    """Register a query with the survey rows it covers and its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in CATALOGUE:
            raise ValueError(f"duplicate query {name}")
        CATALOGUE[name] = Query(name, covers, fn, sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All floating columns to a fixed number of digits, so both engines' sums agree."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in names})
