"""Tables that other databases own: emissions and energy certificates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.delimited import import_tables

#: Names of the tables as their owners keep them.
EMISSIONS, CERTIFICATES = "emissions_tbl", "epc_domestic_tbl"


def import_external(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Copies both tables from one schema of the catalog into another and hands them back."""
    import_tables(spark, source, target, [EMISSIONS, CERTIFICATES])
    return {name: spark.table(f"{target}.{name}") for name in (EMISSIONS, CERTIFICATES)}
