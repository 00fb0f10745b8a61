"""A power station's half-hourly generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import mwh_to_gwh, round_half_even
from ..operators.aggregates import ratio_percent, total

# The record columns that analysis does without.
UNUSED = ["dataset", "psrtype", "nationalgridbmunitid"]


def station_generation(raw: DataFrame, keep_settlement_date: bool = True) -> DataFrame:
    """Readings under analysis names; the settlement date, the day that was asked for, may be left out too."""
    unused = UNUSED if keep_settlement_date else [*UNUSED, "settlementdate"]
    return raw.drop(*unused).withColumnsRenamed({"quantity": "generation_mwh"})


def station_daily(readings: DataFrame, by: str = "end_time") -> DataFrame:
    """Total for each unit and day; by end time, midnight counts to the next day."""
    day: Column = F.to_date("halfhourendtime") if by == "end_time" else F.col("settlementdate")
    return readings.groupBy(day.alias("date"), "bmunit").agg(
        total("generation_mwh", "zero").alias("generation_mwh")
    )


def station_year(readings: DataFrame) -> DataFrame:
    """Annual GWh and the year of the first reading."""
    return readings.agg(
        mwh_to_gwh(F.sum("generation_mwh")).alias("generation_gwh"),
        F.year(F.min("halfhourendtime")).alias("year"),
    )


def percent_renewable(renewable: DataFrame, station: DataFrame) -> DataFrame:
    """Renewable percent of renewable plus station generation, rounded to a whole number."""
    pct = ratio_percent(renewable, "gen_gwh", station, "generation_gwh")
    return renewable.sparkSession.range(1).select(
        round_half_even(pct).alias("percent_renewable_generation")
    )
