"""Greenhouse-gas emissions, carbon intensity and air-quality mortality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import sortable_year
from ..functions.numbers import kt_to_mt
from ..functions.text import char_slice, replace_first, sentence_case
from ..operators.aggregates import share_of_total, sum_columns, total, weighted_mean
from ..operators.columns import ending
from ..operators.filters import include_exclude, latest_slice, members_of, trailing_slice
from ..operators.joins import lookup
from ..operators.ranking import top
from ..operators.reshape import to_long

EMISSIONS = "territorial_emissions_kt_co2e"

# What names the air-quality indicator, and what rules it out.
MORTALITY_NAME = "mortality.*pollution|pollution.*mortality"
OLD_METHOD = "old"


def _in(emissions: DataFrame, authorities: DataFrame) -> DataFrame:
    codes = authorities.select(F.col("ladcd").alias("local_authority_code"))
    return members_of(emissions, "local_authority_code", codes)


def latest_emissions_by_authority(emissions: DataFrame, authorities: DataFrame) -> DataFrame:
    """Latest year's total by authority; a missing value poisons the total."""
    rows = latest_slice(_in(emissions, authorities), "calendar_year", emissions)
    return rows.groupBy("local_authority").agg(total(EMISSIONS, "poison").alias("total_emissions"))


def emissions_by_year(emissions: DataFrame, authorities: DataFrame, back: int = 9) -> DataFrame:
    rows = trailing_slice(_in(emissions, authorities), "calendar_year", back, emissions)
    return rows.groupBy("calendar_year", "local_authority").agg(
        total(EMISSIONS, "poison").alias("total_emissions")
    )


def emissions_by_sector(emissions: DataFrame, authorities: DataFrame) -> DataFrame:
    """Latest year's total and share by sector."""
    rows = latest_slice(_in(emissions, authorities), "calendar_year", emissions)
    sums = rows.groupBy("la_ghg_sector").agg(total(EMISSIONS, "poison").alias("total_emissions"))
    return share_of_total(sums, "total_emissions", "pct")


def regional_emissions_long(wide: DataFrame, first_only: bool = True) -> DataFrame:
    """Sector totals by year in Mt, from every ``*total`` column but the grand total.

    Only the first underscore of a sector name turns into a space, unless
    ``first_only`` is off.
    """
    names = [c for c in ending(wide, "total") if c != "grand_total"]
    sums = sum_columns(wide, ["calendar_year"], names, "zero")
    long = to_long(sums, ["calendar_year"], "sector", "emissions_ktco2e", keep_nulls=True)
    bare = F.regexp_replace("sector", "_total", "")
    spaced = replace_first(bare, "_", " ") if first_only else F.replace(bare, F.lit("_"), F.lit(" "))
    shown = F.concat(F.upper(char_slice(spaced, 1, 1)), F.lower(char_slice(spaced, 2)))
    return long.select(
        "calendar_year",
        shown.alias("sector"),
        "emissions_ktco2e",
        kt_to_mt("emissions_ktco2e").alias("emissions_mtco2e"),
    )


def target_year(emissions: DataFrame, wanted: int) -> Column:
    """The wanted year if the table has it, else its latest."""
    found = emissions.agg(
        F.coalesce(
            F.max(F.when(F.col("calendar_year") == wanted, F.lit(wanted))), F.max("calendar_year")
        )
    )
    return found.scalar()


def top_emitter(emissions: DataFrame, wanted: int) -> DataFrame:
    """The authority with the greatest total of the year."""
    rows = emissions.where(F.col("calendar_year") == target_year(emissions, wanted))
    sums = rows.groupBy("local_authority").agg(total(EMISSIONS, "zero").alias("total_emissions"))
    return top(sums, 1, "total_emissions")


def sector_trend(emissions: DataFrame, authority: str, sector: str, since: int) -> DataFrame:
    """One authority's emissions of one sector by year."""
    rows = emissions.where(
        (F.col("local_authority") == authority)
        & (F.col("la_ghg_sector") == sector)
        & (F.col("calendar_year") >= since)
    )
    sums = rows.groupBy("calendar_year").agg(total(EMISSIONS, "zero").alias("total_emissions"))
    return sums.orderBy("calendar_year")


def carbon_bands(raw: DataFrame) -> DataFrame:
    """Category bands; the open-ended upper limit is not one."""
    return raw.drop("very_high_upper_limit")


def mortality_indicators(indicators: DataFrame) -> DataFrame:
    return indicators.where(include_exclude("indicator_name", MORTALITY_NAME, OLD_METHOD))


def weighted_mortality(
    values: DataFrame, population: DataFrame, codes: list[str], require_rate: bool = False
) -> DataFrame:
    """Latest year's fraction over the chosen areas, weighted by population."""
    latest = values.agg(sortable_year(F.max("timeperiod_sortable"))).scalar()
    rows = values.where(F.col("area_code").isin(codes) & (F.col("timeperiod") == latest))
    joined = lookup(rows, population, {"area_name": "local_authority"}, "keep")
    return weighted_mean(joined, "value", "population", "mortality_fraction", require_rate)


def sector_names(emissions: DataFrame) -> DataFrame:
    return emissions.select(sentence_case("la_ghg_sector").alias("sector")).distinct()
