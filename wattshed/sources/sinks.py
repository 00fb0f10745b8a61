"""Writers: tables, views, files, verified writes and whole-run publication."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .records import to_area_features, to_features


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the table or overwrite it; with ``path`` its files live there."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the table; an error when it exists."""
    writer = df.write.mode("errorifexists").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str, null: str = "") -> None:
    """A header in each file; missing values as ``null``; a quote inside a cell is doubled.

    White space at the ends of a cell stays.
    """
    writer = df.write.mode("overwrite").option("header", True).option("nullValue", null)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("quote", '"').option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, partitioned if asked.

    Rows gather by partition value first, so that a value does not get a file
    from every task. Adaptive execution then evens the tasks out by size: a hot
    value is written by many of them, small values share one.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    gathered = df.hint("rebalance", *partition_by)
    gathered.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_features(df: DataFrame, path: str, x: str, y: str) -> None:
    """One point feature to a line."""
    to_features(df, x, y).write.mode("overwrite").text(path)


def write_area_features(df: DataFrame, path: str, parts: str = "parts") -> None:
    """One polygon or multipolygon feature to a line."""
    to_area_features(df, parts).write.mode("overwrite").text(path)


def write_verified(df: DataFrame, path: str) -> int:
    """Write Parquet, read it back and compare row counts; returns the count.

    The count on writing is observed by the write itself, with no second run.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    written = seen.get["n"]
    found = df.sparkSession.read.parquet(path).count()
    if written != found:
        raise RuntimeError(f"wrote {written} rows to {path} but read {found}")
    return found


LOG, STAGED = "_published", "_staged"
_LOG = "run string, published timestamp, names array<string>, paths map<string,string>, prints map<string,string>"
_STAGED = "path string, print string, written timestamp"


def _table_of(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of small rows, empty as long as nothing has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stage_output(df: DataFrame, root: str, run: str, name: str, print_: str | None = None) -> DataFrame:
    """Write one output under the run's own folder and hand back what was written.

    With a fingerprint, a row remembers that the output is whole, for a later run
    to take up.
    """
    spark, path = df.sparkSession, f"{root}/run={run}/{name}"
    df.write.mode("errorifexists").parquet(path)
    if print_:
        row = spark.range(1).select(
            F.lit(path).alias("path"), F.lit(print_).alias("print"), F.current_timestamp().alias("written")
        )
        row.coalesce(1).write.mode("append").parquet(f"{root}/{STAGED}")
    return spark.read.schema(df.schema).parquet(path)


def staged_outputs(spark: SparkSession, root: str) -> dict[str, str]:
    """Path by fingerprint of every whole output under root, published or not: a row for each step of each run."""
    found = _table_of(spark, f"{root}/{STAGED}", _STAGED).groupBy("print")
    return {r["print"]: r["path"] for r in found.agg(F.max_by("path", "written").alias("path")).collect()}


def commit_run(
    spark: SparkSession,
    root: str,
    run: str,
    names: list[str],
    paths: dict[str, str] | None = None,
    prints: dict[str, str] | None = None,
) -> None:
    """One row in the log makes the whole run visible; outputs taken over from earlier runs stay where they are."""

    def pairs(given: dict[str, str]):
        flat = [F.lit(x) for pair in given.items() for x in pair]
        return F.create_map(*flat) if flat else F.create_map().cast("map<string,string>")

    row = spark.range(1).select(
        F.lit(run).alias("run"),
        F.current_timestamp().alias("published"),
        F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("names"),
        pairs({n: f"{root}/run={run}/{n}" for n in names} | (paths or {})).alias("paths"),
        pairs(prints or {}).alias("prints"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/{LOG}")


def publish(spark: SparkSession, outputs: dict[str, DataFrame], root: str) -> str:
    """Make all outputs of a run visible together, or none.

    Each is written under the run's own folder. Only when every write has
    succeeded is one row added to the log, and readers follow the log.
    """
    run = uuid.uuid4().hex
    for name, df in outputs.items():
        stage_output(df, root, run, name)
    commit_run(spark, root, run, list(outputs))
    return run


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of the latest published run that has it."""
    log = _table_of(spark, f"{root}/{LOG}", _LOG).where(F.array_contains("names", name))
    path = log.agg(F.max_by(F.col("paths")[name], "published")).first()[0]
    if path is None:
        raise LookupError(f"{name} has not been published under {root}")
    return spark.read.parquet(path)


def publish_views(spark: SparkSession, root: str, names: list[str]) -> None:
    for name in names:
        read_published(spark, root, name).createOrReplaceTempView(name)
