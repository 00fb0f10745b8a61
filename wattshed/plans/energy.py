"""Energy and electricity use by authority, fuel and sector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import (
    ktoe_to_gwh,
    lenient_cast,
    main_or_other,
    marker_cast,
    percent_change,
    round_half_even,
)
from ..functions.text import sentence_case, strip_note
from ..operators.aggregates import share_of_total, total
from ..operators.filters import (
    first_and_last_slice,
    latest_slice,
    members_of,
    not_in_or_null,
    trailing_slice,
)
from ..operators.joins import lookup
from ..operators.ordered import display_midpoint, with_change
from ..operators.ranking import list_position
from ..operators.reshape import pivot_found, pivot_sum, to_long
from ..sources.sheets import long_table, wide_table

# Header rows of the two workbooks, and the id columns of each sheet.
ENERGY_HEADER_ROW = 6
ELECTRICITY_HEADER_ROW = 5
ENERGY_IDS = ["country_or_region", "local_authority", "code"]
NOT_AUTHORITIES = ["Unallocated", "All local authorities"]
MAIN_FUELS = ["Electricity", "Gas", "Petroleum"]
SECTOR_ORDER = ["Industrial commercial and other", "Transport", "Domestic"]


def electricity_by_authority(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Yearly sheets side by side, English authorities only, year from the sheet name."""
    wide = wide_table(cells, ELECTRICITY_HEADER_ROW, columns, blank_rows=False)
    return wide.where(F.col("code").startswith("E0")).select(
        *columns, F.col("sheet").cast("int").alias("calendar_year")
    )


def energy_long(cells: DataFrame, only: list[str] | None = None) -> DataFrame:
    """All yearly sheets to (authority, year, fuel_sector, ktoe) in one pass.

    ``only`` names the measures wanted; the cells of others are then not shuffled.
    """
    long = long_table(
        cells, ENERGY_HEADER_ROW, ENERGY_IDS, "fuel_sector", "ktoe", drop=["notes"], clean=strip_note, only=only
    )
    return _english_years(long).select(
        *ENERGY_IDS, "calendar_year", "fuel_sector", marker_cast("ktoe").alias("ktoe")
    )


def _english_years(long: DataFrame) -> DataFrame:
    year = F.col("sheet").cast("int")
    return long.where(F.col("code").startswith("E0")).withColumn("calendar_year", year)


def fuel_sector_lookup(raw: DataFrame) -> DataFrame:
    """Names split into fuel and sector, in sentence case."""
    return raw.select(
        sentence_case("fuel").alias("fuel"),
        sentence_case("sector").alias("sector"),
        F.col("original_string").alias("fuel_sector"),
    )


def energy_by_fuel_sector(long: DataFrame, names: DataFrame) -> DataFrame:
    """Long energy with fuel and sector; names not in the lookup drop out."""
    return long.join(names, "fuel_sector").select(
        "country_or_region",
        F.col("code").alias("ladcd"),
        F.col("local_authority").alias("ladnm"),
        "ktoe",
        "calendar_year",
        "fuel",
        "sector",
    )


def energy_view(cells: DataFrame, names: DataFrame, which: Column | None = None) -> DataFrame:
    """The same straight from the sheets, for the rows of the lookup where ``which`` holds.

    Fuel and sector meet the column headers, not the cells, and only the cells of
    columns that the lookup keeps are shuffled.
    """
    kept = names if which is None else names.where(which)
    long = long_table(
        cells, ENERGY_HEADER_ROW, ENERGY_IDS, "fuel_sector", "ktoe", clean=strip_note, lookup=kept
    )
    return _english_years(long).select(
        "country_or_region",
        F.col("code").alias("ladcd"),
        F.col("local_authority").alias("ladnm"),
        marker_cast("ktoe").alias("ktoe"),
        "calendar_year",
        "fuel",
        "sector",
    )


def clean_energy_long(cells: DataFrame, names: DataFrame, columns: list[str]) -> DataFrame:
    """Every authority row, cells lenient to numbers, missing cells kept, lookup misses kept."""
    wide = wide_table(cells, ENERGY_HEADER_ROW, [*ENERGY_IDS, *columns], clean=strip_note)
    rows = wide.where(not_in_or_null("local_authority", NOT_AUTHORITIES)).select(
        F.col("sheet").cast("int").alias("year"),
        "country_or_region",
        F.col("local_authority").alias("ladnm"),
        F.col("code").alias("ladcd"),
        *[lenient_cast(c).alias(c) for c in columns],
    )
    ids = ["year", "country_or_region", "ladnm", "ladcd"]
    long = to_long(rows, ids, "fuel_sector", "value", keep_nulls=True)
    return lookup(long, names, {"fuel_sector": "fuel_sector"}, "keep").drop("fuel_sector")


def regional_energy_gwh(cells: DataFrame, names: DataFrame, region: str) -> DataFrame:
    """One region's authorities in ktoe and GWh, totals left out."""
    single = ~F.col("fuel_sector").startswith("all") & ~F.col("fuel_sector").endswith("total")
    long = long_table(
        cells, ENERGY_HEADER_ROW, ENERGY_IDS, "fuel_sector", "ktoe", clean=strip_note, lookup=names.where(single)
    )
    kept = long.where(
        (F.col("country_or_region") == region) & (F.col("local_authority") != "All local authorities")
    )
    ktoe = lenient_cast("ktoe")
    return kept.select(
        F.col("sheet").cast("int").alias("year"),
        "local_authority",
        "code",
        "fuel_sector",
        ktoe.alias("consumption_ktoe"),
        ktoe_to_gwh(ktoe).alias("consumption_gwh"),
        "fuel",
        "sector",
    )


def electricity_by_year_wide(
    electricity: DataFrame, codes: list[str], years: list[int] | None, measure: str
) -> DataFrame:
    """One row with a summed column for each year; without ``years``, for each that the data have."""
    chosen = electricity.where(F.col("code").isin(codes)).select(
        F.col("calendar_year").alias("year"), F.col(measure).cast("double").alias("x")
    )
    return pivot_found(chosen, [], "year", "x") if years is None else pivot_sum(chosen, [], "year", "x", years)


def electricity_change(wide: DataFrame, old: int, new: int, base: str = "old") -> DataFrame:
    return wide.select(
        percent_change(F.col(f"`{old}`"), F.col(f"`{new}`"), base).alias("change_in_consumption")
    )


def all_fuels_by_sector() -> Column:
    """Rows of the lookup, or of a view, that the answer by sector is about."""
    return (F.col("fuel") == "All fuels") & (F.col("sector") != "Total")


def all_energy() -> Column:
    """Those that hold the total of all fuels and sectors."""
    return (F.col("fuel") == "All fuels") & (F.col("sector") == "Total")


def totals_by_fuel() -> Column:
    """Those that hold one fuel's total."""
    return (F.col("sector") == "Total") & (F.col("fuel") != "All fuels")


def _or(years: DataFrame | None, view: DataFrame) -> DataFrame:
    """Where the latest year is looked up.

    A view that is computed on the fly would be computed once more for it; any
    cheaper table with the same years in ``calendar_year`` may be given instead.
    """
    return view if years is None else years


def _in_authorities(view: DataFrame, authorities: DataFrame) -> DataFrame:
    return members_of(view, "ladcd", authorities)


def energy_by_sector(
    view: DataFrame, authorities: DataFrame, years: DataFrame | None = None
) -> DataFrame:
    """Latest year, all fuels: each sector's energy, share and GWh."""
    rows = latest_slice(_in_authorities(view, authorities), "calendar_year", _or(years, view)).where(
        all_fuels_by_sector()
    )
    sums = rows.groupBy("sector").agg(total("ktoe", "zero").alias("energy_ktoe"))
    return share_of_total(sums, "energy_ktoe", "pct_sector").withColumn(
        "energy_gwh", ktoe_to_gwh("energy_ktoe")
    )


def with_sector_icons(sectors: DataFrame, icons: dict[str, str]) -> DataFrame:
    """The display name of each sector's icon; sectors without one keep NULL."""
    named = F.create_map(*[F.lit(x) for pair in icons.items() for x in pair])
    return sectors.withColumn("icon", F.try_element_at(named, F.col("sector")))


def energy_change(
    view: DataFrame, authorities: DataFrame, years: DataFrame | None = None
) -> DataFrame:
    """First and last year's total energy, with the change; a missing value poisons its year."""
    chosen = _in_authorities(view, authorities)
    rows = first_and_last_slice(chosen, "calendar_year", _or(years, view)).where(all_energy())
    sums = rows.groupBy("calendar_year").agg(
        total(ktoe_to_gwh("ktoe"), "poison").alias("total_energy_gwh")
    )
    return with_change(sums, "calendar_year", "total_energy_gwh")


def energy_by_main_fuel(
    view: DataFrame, authorities: DataFrame, years: DataFrame | None = None
) -> DataFrame:
    """Latest year, all sectors: three fuels and the rest, with percent shares."""
    rows = latest_slice(_in_authorities(view, authorities), "calendar_year", _or(years, view)).where(
        totals_by_fuel()
    )
    sums = rows.groupBy(main_or_other("fuel", MAIN_FUELS).alias("fuel_type")).agg(
        total("ktoe", "zero").alias("energy_ktoe")
    )
    return share_of_total(sums, "energy_ktoe", "pct_fuel", 100).withColumn(
        "percent_fuel", round_half_even("pct_fuel")
    )


def sector_label_positions(sectors: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rounded percent for each sector and the middle of its arc in display order."""
    order = SECTOR_ORDER if order is None else order
    place = F.coalesce(list_position("sector", order), F.lit(len(order) + 1))
    values = sectors.select(
        "sector", round_half_even(F.col("pct_sector") * 100).alias("value"), place.alias("place")
    )
    return display_midpoint(values, ["place", "sector"], "value", "y_pos").withColumn(
        "label_text", F.concat(F.col("value").cast("int").cast("string"), F.lit("%"))
    )


def energy_by_authority_recent(
    view: DataFrame, authorities: DataFrame, back: int = 9, years: DataFrame | None = None
) -> DataFrame:
    """Total GWh of each authority over the last ``back + 1`` years."""
    chosen = _in_authorities(view, authorities)
    rows = trailing_slice(chosen, "calendar_year", back, _or(years, view))
    return rows.where(all_energy()).select(
        "calendar_year", "ladnm", ktoe_to_gwh("ktoe").alias("gwh")
    )


def electricity_total(extract: DataFrame, names: list[str], year: int) -> DataFrame:
    """Electricity of the named authorities in one year, from a landed extract."""
    chosen = extract.where(
        F.col("local_authority").isin(names)
        & (F.col("year") == year)
        & (F.col("fuel") == "Electricity")
    )
    return chosen.agg(total("consumption_gwh", "zero").alias("total_consumption_gwh"))
