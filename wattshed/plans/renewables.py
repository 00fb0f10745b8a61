"""Renewable sites, capacity and generation; planning sites; generators in a boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_dmy, year_from_label
from ..functions.geography import grid_to_lonlat, grid_to_points
from ..functions.numbers import lenient_cast, marker_cast, mwh_to_gwh, round_half_away
from ..functions.text import sentence_case, strip_note
from ..operators.aggregates import share_of_total, total_of_columns
from ..operators.filters import latest_slice, members_of, trailing_slice
from ..operators.joins import lookup, points_in_polygons
from ..sources.sheets import long_table, sheet_names, wide_table
from ..sources.sinks import replace_table, write_csv, write_features

# The twelve technologies, the id columns, the measures and units.
TECHNOLOGIES = [
    "photovoltaics",
    "onshore_wind",
    "hydro",
    "anaerobic_digestion",
    "offshore_wind",
    "wave_tidal",
    "sewage_gas",
    "landfill_gas",
    "municipal_solid_waste",
    "animal_biomass",
    "plant_biomass",
    "cofiring",
]
RENEWABLE_IDS = [
    "local_authority_code",
    "local_authority_name",
    "estimated_number_of_households",
    "region",
    "country",
]
UNITS = {"Sites": "number", "Capacity": "mw", "Generation": "mwh"}
MEASURES = {
    "Sites": "sites_number",
    "Capacity": "capacity_mw",
    "Generation": "generation_mwh",
}
SITE_COLUMNS = [
    "site_name",
    "operational_date",
    "year",
    "record_last_updated_ddmmyyyy",
    "technology_type",
    "storage_type",
    "installed_capacity_mwelec",
    "share_community_scheme",
    "development_status",
    "planning_authority",
    "county",
    "post_code",
    "bng_x",
    "bng_y",
]
HEADER_ROWS = {"Sites": 4, "Capacity": 4, "Generation": 5}


def sheet_type(sheet: str = "sheet") -> Column:
    """Sites, Capacity or Generation, from a name such as ``LA - Sites 2024``."""
    return F.nullif(
        F.regexp_extract(sheet, "(" + "|".join(UNITS) + ")", 1), F.lit("")
    )


def has_type(sheet: str = "sheet") -> Column:
    """Whether a sheet has a type, by plain search: cells are many, and their sheets few."""
    first, *more = UNITS
    found = F.col(sheet).contains(first)
    for kind in more:
        found = found | F.col(sheet).contains(kind)
    return found


def header_row(sheet: str = "sheet") -> Column:
    c = F.col(sheet)
    rule = F.when(c.contains("Generation"), HEADER_ROWS["Generation"])
    return rule.otherwise(HEADER_ROWS["Sites"])


def _labels(kind: Column, labels: dict[str, str]) -> Column:
    pairs = list(labels.items())
    rule = F.when(kind == pairs[0][0], pairs[0][1])
    for key, label in pairs[1:]:
        rule = rule.when(kind == key, label)
    return rule


def sheet_name(kind: str, year: int) -> str:
    """The naming rule of the workbook: a comma before the year, but not for Sites."""
    return f"LA - {kind}{' ' if kind == 'Sites' else ', '}{year}"


def renewables_long(cells: DataFrame, round_to_int: bool = False) -> DataFrame:
    """All sheets of three measures and all years to long rows, NULL values dropped.

    ``round_to_int`` rounds megawatts to whole numbers, which loses small sites.
    """
    kind = sheet_type()
    long = long_table(
        cells.where(has_type()),
        header_row(),
        RENEWABLE_IDS,
        "energy_source",
        "val",
        clean=strip_note,
        lowest_header=max(HEADER_ROWS.values()),
        of_sheet={
            "calendar_year": year_from_label("sheet"),
            "type": kind,
            "units": _labels(kind, UNITS),
        },
    )
    value = marker_cast("val", "int" if round_to_int else "double")
    return (
        long.where(F.col("local_authority_code").startswith("E0"))
        .select(
            *RENEWABLE_IDS,
            "energy_source",
            "calendar_year",
            "type",
            "units",
            value.alias("value"),
        )
        .where(F.col("value").isNotNull())
    )


def combined_renewables(cells: DataFrame) -> DataFrame:
    """Wide rows of every sheet, numbers lenient, year and measure from the sheet name."""
    columns = [*RENEWABLE_IDS, *TECHNOLOGIES]
    wide = wide_table(
        cells.where(has_type()),
        header_row(),
        columns,
        clean=strip_note,
        blank_rows=False,
        lowest_header=max(HEADER_ROWS.values()),
    )
    numeric = ["estimated_number_of_households", *TECHNOLOGIES]
    english = wide.where(F.col("local_authority_code").startswith("E0"))
    return english.withColumns({c: lenient_cast(c) for c in numeric}).select(
        *columns,
        F.col("sheet").alias("source"),
        year_from_label("sheet").alias("year"),
        _labels(sheet_type(), MEASURES).alias("measure"),
    )


def sheet_years(cells: DataFrame) -> DataFrame:
    """The year of each renewables sheet, from the names of the sheets alone.

    As ``years`` of the answers below it spares them a second run of the whole
    sheet pipeline for its latest year, and lets only that year's cells be read.
    """
    year = year_from_label("sheet")
    named = sheet_names(cells).where(sheet_type().isNotNull())
    return named.select(year.alias("year"), year.alias("calendar_year")).distinct()


def latest_capacity_total(
    renewables: DataFrame, codes: list[str], years: DataFrame | None = None
) -> DataFrame:
    """Latest year's capacity over all technologies; one summed pass, no reshape to rows."""
    rows = latest_slice(renewables, "year", years).where(
        F.col("local_authority_code").isin(codes) & (F.col("measure") == "capacity_mw")
    )
    return rows.agg(total_of_columns(TECHNOLOGIES).alias("total_capacity"))


def latest_capacity_by_lookup(
    renewables: DataFrame, ca_la: DataFrame, authority: str, years: DataFrame | None = None
) -> DataFrame:
    """The same through the combined-authority lookup, missing values kept and ignored in the sum."""
    rows = latest_slice(renewables, "year", years).where(F.col("measure") == "capacity_mw")
    joined = lookup(rows, ca_la, {"local_authority_code": "ladcd"}).where(
        F.col("cauthnm") == authority
    )
    return joined.agg(total_of_columns(TECHNOLOGIES, "zero").alias("total_capacity_mw"))


def generation_by_source(
    renewables: DataFrame, authorities: DataFrame, years: DataFrame | None = None
) -> DataFrame:
    """Latest year's generation by authority and source, positive values, in GWh."""
    latest = latest_slice(renewables, "calendar_year", years).where(
        (F.col("type") == "Generation")
        & (F.col("energy_source") != "total")
        & (F.col("value") > 0)
    )
    codes = authorities.select(F.col("ladcd").alias("local_authority_code"))
    return members_of(latest, "local_authority_code", codes).select(
        "local_authority_code",
        "local_authority_name",
        "calendar_year",
        sentence_case("energy_source", lower_rest=True).alias("source"),
        mwh_to_gwh("value").alias("gen_gwh"),
    )


def generation_total(by_source: DataFrame) -> DataFrame:
    return by_source.agg(F.sum("gen_gwh").alias("total_gwh"))


def generation_by_combined_authority(renewables: DataFrame, ca_la: DataFrame) -> DataFrame:
    """Total generation by year and combined authority."""
    rows = renewables.where(F.col("measure") == "generation_mwh")
    joined = lookup(rows, ca_la, {"local_authority_code": "ladcd"})
    return joined.groupBy("year", "cauthnm").agg(
        total_of_columns(TECHNOLOGIES, "zero").alias("total_generation")
    )


def highlighted(by_authority: DataFrame, authority: str) -> DataFrame:
    """Mark one authority against the others, as a two-way class."""
    return by_authority.withColumn(
        "highlight", F.when(F.col("cauthnm") == authority, "chosen").otherwise("other")
    )


def planning_sites(raw: DataFrame) -> DataFrame:
    """All columns plus the longitude-latitude point."""
    return grid_to_points(raw, "xcoordinate", "ycoordinate", "geometry")


def operational_sites(raw: DataFrame, counties: list[str]) -> DataFrame:
    """Operational sites with a capacity in the named counties, with date, year and point.

    Columns of the register that a release does not have are left out.
    """
    kept = raw.where(
        F.col("county").isin(counties)
        & F.col("installed_capacity_mwelec").isNotNull()
        & (F.col("development_status_short") == "Operational")
    )
    day = parse_dmy("operational")
    new = {
        "operational_date": day,
        "year": F.year(day),
        "installed_capacity_mwelec": F.col("installed_capacity_mwelec").cast("double"),
        "bng_x": F.col("xcoordinate"),
        "bng_y": F.col("ycoordinate"),
    }
    wanted = [c for c in SITE_COLUMNS if c in new or c in raw.columns]
    sites = kept.select(*[new.get(c, F.col(c)).alias(c) for c in wanted])
    return grid_to_points(sites, "bng_x", "bng_y", "geo_point_2d")


def capacity_added(sites: DataFrame, back: int = 5) -> DataFrame:
    """Capacity that came in since the latest year minus ``back``."""
    return trailing_slice(sites, "year", back).agg(
        F.sum("installed_capacity_mwelec").alias("capacity_added")
    )


def community_energy_added(sites: DataFrame, back: int = 5) -> DataFrame:
    return trailing_slice(sites, "year_installed", back).agg(F.sum("k_wp").alias("k_wp_added"))


def generators_placed(generators: DataFrame) -> DataFrame:
    """Generators with capacity as a number, longitude and latitude."""
    typed = generators.select(
        "type",
        "technology",
        "primary_fuel",
        F.col("installedcapacity_mw").cast("double").alias("capacity"),
        "postcode",
        F.col("xcoordinate").cast("double").alias("xcoordinate"),
        F.col("ycoordinate").cast("double").alias("ycoordinate"),
    )
    return grid_to_lonlat(typed, "xcoordinate", "ycoordinate").drop("xcoordinate", "ycoordinate")


def generators_within(
    generators: DataFrame, boundary: DataFrame, boundary_id: str, rings: str, cell: float
) -> DataFrame:
    """Generators inside the boundary polygons, by longitude and latitude."""
    placed = generators_placed(generators)
    return points_in_polygons(placed, "lon", "lat", boundary, boundary_id, rings, cell)


def export_generators(
    generators: DataFrame,
    boundary: DataFrame,
    boundary_id: str,
    rings: str,
    cell: float,
    renewable_total: DataFrame,
    folder: str,
    table: str,
) -> None:
    """All that is published of the generators, under folder and as a table.

    Every generator as a feature; those inside the boundary as a table and as CSV;
    fossil against renewable capacity, and the summary by source, as CSV. What is
    inside is worked out once, for the table; the rest reads that.
    """
    write_features(generators_placed(generators), f"{folder}/generators", "lon", "lat")
    within = generators_within(generators, boundary, boundary_id, rings, cell).drop(boundary_id)
    replace_table(within, table)
    stored = within.sparkSession.table(table)
    write_csv(stored, f"{folder}/generators_within")
    write_csv(fossil_and_renewable(stored, renewable_total), f"{folder}/renewables_fossil")
    write_csv(energy_source_summary(stored), f"{folder}/energy_source_summary")


def fossil_and_renewable(within: DataFrame, renewable_total: DataFrame) -> DataFrame:
    """Two rows: fossil capacity by a name match, renewable capacity from its own source."""
    fossil = within.agg(F.sum(F.when(F.col("technology").ilike("%fossil%"), F.col("capacity"))))
    rows = within.sparkSession.range(1).select(
        F.inline(
            F.array(
                F.struct(F.lit("Fossil").alias("category"), fossil.scalar().alias("capacity")),
                F.struct(
                    F.lit("Renewable").alias("category"), renewable_total.scalar().alias("capacity")
                ),
            )
        )
    )
    return rows


def energy_source_summary(within: DataFrame) -> DataFrame:
    """Capacity and its share for fossil fuel and all else, missing technology included."""
    kind = F.when(F.col("technology") == "Fossil Fuel", "Fossil").otherwise("Renewable")
    sums = within.groupBy(kind.alias("fuel_category")).agg(F.sum("capacity").alias("_c"))
    rounded = sums.withColumn("installed_capacity_mw", round_half_away("_c", 1))
    whole = within.agg(F.sum("capacity")).scalar()
    share = F.try_divide(F.col("installed_capacity_mw") * 100, whole)
    return rounded.select(
        "fuel_category",
        "installed_capacity_mw",
        round_half_away(share, 1).alias("proportion_of_total"),
    )


def technology_shares(long: DataFrame) -> DataFrame:
    sums = long.groupBy("energy_source").agg(F.sum("value").alias("value"))
    return share_of_total(sums, "value", "share")
