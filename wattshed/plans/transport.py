"""Charge points, licensed vehicles and vehicle mileage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_quarter
from ..functions.numbers import half_away_int, marker_cast
from ..functions.text import char_slice
from ..sources.sheets import long_table

# Header rows, and the two-digit year pattern for quarter labels.
CHARGE_POINT_HEADER_ROW = 3
MILEAGE_HEADER_ROW = 5
QUARTER_LABEL = r"^[A-Z][a-z]{2}-[0-9]{2}"


def charge_points(
    cells: DataFrame,
    sheet: str,
    code: str = "local_authority_region_code",
    name: str = "local_authority_region_name",
    out: str = "installs",
    round_to_int: bool = True,
) -> DataFrame:
    """Quarterly columns to long rows for English authorities, suppressed cells dropped.

    Header notes go before the names are compared, so the code column is found
    with and without one. Only quarter columns count as values.
    """
    chosen = cells.where(F.col("sheet") == sheet)
    tidy = chosen.withColumn(
        "value",
        F.when(
            F.col("row") == CHARGE_POINT_HEADER_ROW,
            F.trim(F.regexp_replace("value", r"\s*\[[^\]]*\]", "")),
        ).otherwise(F.col("value")),
    )
    plain = F.regexp_replace(
        F.regexp_replace(F.lower(F.col("value")), r"[^\w\s]", ""), r"\s+", "_"
    )
    heads = tidy.withColumn(
        "value",
        F.when(
            (F.col("row") == CHARGE_POINT_HEADER_ROW) & ~F.col("value").rlike(QUARTER_LABEL), plain
        ).otherwise(F.col("value")),
    )
    long = long_table(heads, CHARGE_POINT_HEADER_ROW, [code, name], "q_y", "cell", style="as_is")
    value = marker_cast("cell", "int" if round_to_int else "double")
    return (
        long.where(F.col(code).startswith("E0") & F.col("q_y").rlike(QUARTER_LABEL))
        .select(
            F.col(code).alias("la_region_code"),
            F.col(name).alias("la_region_name"),
            parse_quarter("q_y").alias("quarter"),
            value.alias(out),
        )
        .where(F.col(out).isNotNull())
    )


def electric_registrations(vehicles: DataFrame, period: str) -> DataFrame:
    """Battery and plug-in vehicles by small area, where the count is given."""
    return vehicles.where(
        (F.col(period) != "[c]")
        & ((F.col("fuel") == "Battery electric") | F.col("fuel").startswith("Plug"))
    ).select("lsoa11cd", "lsoa11nm", "fuel", F.col(period).alias("_count"))


def latest_vehicles(vehicles: DataFrame, period: str, breakdown: list[str]) -> DataFrame:
    """English small areas, one period, totals and suppressed counts left out."""
    kept = ~F.col(period).startswith("[") & F.col("lsoa11cd").startswith("E")
    for c in breakdown:
        kept = kept & (F.col(c) != "Total")
    return vehicles.where(kept).select(
        "lsoa11cd", "lsoa11nm", *breakdown, half_away_int(period).alias(period)
    )


def vehicle_mileage(cells: DataFrame) -> DataFrame:
    """Mileage by English authority and year; suppressed cells stay, as NULL."""
    long = long_table(
        cells,
        MILEAGE_HEADER_ROW,
        ["local_authority_or_region_code", "local_authority_or_region"],
        "year",
        "mileage_millions",
        drop=["notes", "units", "_"],
    )
    return long.where(
        F.col("local_authority_or_region_code").startswith("E0") & F.col("year").rlike(r"\d$")
    ).select(
        "local_authority_or_region_code",
        "local_authority_or_region",
        char_slice("year", 2, 5).cast("int").alias("year"),
        marker_cast("mileage_millions").alias("mileage_millions"),
    )
