"""Small helpers that the operators share: staged tables, free names, Arrow passes."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattshed.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """df written under the cluster's shared checkpoint folder and read again.

    Cuts lineage and outlives any executor; the schema is given, so that a
    result without rows can be read too.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_by_hash(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The n rows that come first by hash of the columns, or a few less.

    Rows are thinned by their hash before they are sorted, so what tasks send
    stays about 2n rows for all of them together, however many tasks there are.
    """
    total = df.count()
    hashed = F.xxhash64(*columns)
    if total > 2 * n:
        df = df.where(F.pmod(hashed, F.lit(1 << 30)) < int((1 << 30) * 2 * n / total))
    return df.orderBy(hashed, *columns).limit(n)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_struct(df: DataFrame, name: str, kind: T.StructType, make: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """All columns of df and one struct more, computed from each Arrow batch."""

    def each(batches):
        for batch in batches:
            extra = make(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, extra], [*batch.schema.names, name])

    return df.mapInArrow(each, T.StructType([*df.schema.fields, T.StructField(name, kind)]))
