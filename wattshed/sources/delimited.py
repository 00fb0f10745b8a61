"""CSV, Parquet and catalog readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import normalise_columns

BAD_RECORD = "_bad_record"


def csv_reader(
    spark: SparkSession, delimiter: str = ",", null: str = "", multi_line: bool = True
) -> DataFrameReader:
    """A reader of CSV with a header, in the dialect that spreadsheets and databases write.

    A quote inside a quoted cell is doubled, and a quoted cell may hold delimiters
    and line breaks. A file with line breaks inside cells cannot be split, so
    ``multi_line=False`` is for large files that are known to have none.
    """
    return (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", null)
        .option("multiLine", multi_line)
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, style: str | None = None, **dialect
) -> DataFrame:
    """A CSV with a header and a declared schema, so no extra pass guesses types."""
    df = csv_reader(spark, **dialect).schema(schema).csv(path)
    return normalise_columns(df, style) if style else df


def read_csv_text(spark: SparkSession, path: str, style: str | None = None, **dialect) -> DataFrame:
    """Every column as text under the names of the header; only the header is read early."""
    df = csv_reader(spark, **dialect).option("inferSchema", False).csv(path)
    return normalise_columns(df, style) if style else df


def read_csv_guessing(spark: SparkSession, path: str, **dialect) -> DataFrame:
    """Types guessed from the data: one more pass, so for small files only."""
    return csv_reader(spark, **dialect).option("inferSchema", True).csv(path)


def _as_struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _raw_text(spark: SparkSession, path: str, schema: T.StructType, mode: str, **dialect) -> DataFrame:
    """All columns as text. Rows are judged by all their cells, not by the selected ones."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if mode == "PERMISSIVE":
        text = text.add(BAD_RECORD, T.StringType())
    return (
        csv_reader(spark, **dialect)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("columnPruning", False)
        .schema(text)
        .csv(path)
    )


def _cell(name: str) -> Column:
    return F.col(f"`{name}`")


def _typed(schema: T.StructType) -> list[Column]:
    return [_cell(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


def _does_not_parse(schema: T.StructType) -> Column:
    """Some cell has text that is not a value of its type."""
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            cell = _cell(f.name)
            bad = bad | (cell.isNotNull() & cell.try_cast(f.dataType).isNull())
    return bad


def read_csv_dropping(
    spark: SparkSession, path: str, schema: T.StructType | str, **dialect
) -> DataFrame:
    """Rows that do not parse are dropped, whichever columns are selected later.

    The reader's own mode converts, and so judges, only the selected columns:
    the same file would keep other rows in other queries.
    """
    kept = _as_struct(schema)
    raw = _raw_text(spark, path, kept, "DROPMALFORMED", **dialect)
    return raw.where(~_does_not_parse(kept)).select(*_typed(kept))


def read_csv_lenient(
    spark: SparkSession, path: str, schema: T.StructType | str, **dialect
) -> DataFrame:
    """Rows that do not parse are kept, with NULLs, and their text in ``_bad_record``."""
    kept = _as_struct(schema)
    raw = _raw_text(spark, path, kept, "PERMISSIVE", **dialect)
    cells = F.concat_ws(",", *[F.coalesce(_cell(f.name), F.lit("")) for f in kept.fields])
    bad = F.coalesce(F.col(BAD_RECORD), F.when(_does_not_parse(kept), cells))
    return raw.select(*_typed(kept), bad.alias(BAD_RECORD))


def read_landed_extract(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    refine: dict[str, list] | None = None,
    group_by: list[str] | None = None,
) -> DataFrame:
    """A landed portal extract with the portal's own refine and group-by-count."""
    df = read_csv(spark, path, schema)
    for name, values in (refine or {}).items():
        df = df.where(F.col(name).isin(values))
    return df.groupBy(*group_by).agg(F.count(F.lit(1)).alias("count")) if group_by else df


def import_tables(spark: SparkSession, source: str, target: str, tables: list[str]) -> None:
    """Copy tables of one catalog schema into another."""
    for name in tables:
        spark.table(f"{source}.{name}").write.mode("overwrite").saveAsTable(f"{target}.{name}")
