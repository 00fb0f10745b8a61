"""Boundaries, the grid connection register and future scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geography import grid_to_lonlat, point
from ..functions.numbers import correct_sentinel, lenient_cast
from ..operators.filters import members_of
from ..sources.records import rings_of


def boundaries(features: DataFrame, keys: list[str]) -> DataFrame:
    """Boundary features, polygons and multipolygons alike, to one row for each ring, with part and ring number."""
    return rings_of(features, keys)


def grid_rings_to_lonlat(rings: DataFrame, keys: list[str]) -> DataFrame:
    """Rings on the national grid to longitude and latitude, corner by corner in generated code.

    The keys must name a ring; its corners meet again in one row, as they were.
    """
    others = [c for c in rings.columns if c != "points"]
    corners = rings.select(*others, F.posexplode("points").alias("_at", "_p"))
    flat = corners.select(*others, "_at", F.col("_p")[0].alias("_e"), F.col("_p")[1].alias("_n"))
    placed = grid_to_lonlat(flat, "_e", "_n", "_lon", "_lat")
    corner = F.struct("_at", F.array("_lon", "_lat").alias("p"))
    rest = [F.first(c).alias(c) for c in others if c not in keys]
    whole = placed.groupBy(*keys).agg(*rest, F.sort_array(F.collect_list(corner)).alias("_points"))
    return whole.select(*others, F.col("_points")["p"].alias("points"))


def connections_at_substations(register: DataFrame, substations: DataFrame) -> DataFrame:
    """Connection register rows with the point of the substation they name."""
    placed = substations.withColumn("geo_point_2d", point("longitude", "latitude"))
    return register.join(placed, register.connection_site == placed.substation_name)


def scenarios_with_codes(scenarios: DataFrame, authorities: DataFrame) -> DataFrame:
    """Scenarios with the first code of the authority named; base year 0 means 2024."""
    names = authorities.select("lad_name", F.element_at("lad_code", 1).alias("lad_code"))
    joined = scenarios.join(names, scenarios.local_authority == names.lad_name)
    return joined.drop("local_authority").withColumn(
        "year", correct_sentinel(F.col("year").cast("int"), 0, 2024)
    )


def scenario_slice(
    scenarios: DataFrame, in_region: DataFrame, scenario: str, technology: str
) -> DataFrame:
    """One scenario and technology for the authorities of the region, values as numbers."""
    names = in_region.select(F.col("ladnm").alias("lad_name"))
    return (
        members_of(scenarios, "lad_name", names)
        .where((F.col("scenario") == scenario) & (F.col("technology") == technology))
        .withColumn("value", lenient_cast("value"))
    )
