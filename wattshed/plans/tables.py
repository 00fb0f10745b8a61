"""The registered set: every named table of the report and what each is made from."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from ..operators.columns import normalise_columns
from ..sources.sheets import wide_table
from . import buildings, emissions, energy, generation, places, renewables, transport
from .registry import Step

#: Columns of the electricity workbook that the tables keep.
ELECTRICITY_COLUMNS = ["code", "local_authority", "electricity_total"]
POVERTY_COLUMNS = ["local_authority_district", "county_or_unitary_authority"]
LOOKUP_COLUMNS = ["lsoa11cd", "lsoa11nm", "ctyua21cd", "ctyua21nm"]


def _small_areas(cells: DataFrame) -> DataFrame:
    return buildings.small_area_lookup(wide_table(cells, 1, LOOKUP_COLUMNS, blank_rows=False))


def _stations(raw: DataFrame) -> DataFrame:
    lower = raw.toDF(*[c.lower() for c in raw.columns])
    return generation.station_generation(lower, keep_settlement_date=False)


def registered(period: str, area_keys: list[str]) -> list[Step]:
    """All steps; ``period`` is the licensing period wanted, ``area_keys`` the properties of the areas."""
    breakdowns = {
        "vehicles_by_fuel": ["fuel"],
        "company_vehicles_by_fuel": ["fuel"],
        "vehicles_by_body_keeper_and_status": ["bodytype", "keepership", "licencestatus"],
    }
    per_head = partial(transport.charge_points, sheet="2a", out="cp_100k")
    return [
        Step("electricity", ("electricity_cells",), partial(energy.electricity_by_authority, columns=ELECTRICITY_COLUMNS)),
        Step("energy_long", ("energy_cells",), energy.energy_long),
        Step("renewables_long", ("renewable_cells",), renewables.renewables_long),
        Step("planning_sites", ("planning_register",), renewables.planning_sites),
        Step("charge_points", ("charging_cells",), partial(transport.charge_points, sheet="1a")),
        Step("charge_points_per_head", ("charging_cells",), per_head),
        Step("authority_areas", ("area_features",), partial(places.boundaries, keys=area_keys)),
        Step("region_boundary", ("boundary_features",), partial(places.boundaries, keys=area_keys)),
        Step("electric_registrations", ("vehicle_rows",), partial(transport.electric_registrations, period=period)),
        Step("fuel_poverty", ("poverty_cells",), partial(buildings.fuel_poverty_by_small_area, columns=POVERTY_COLUMNS)),
        Step("small_areas", ("lookup_cells",), _small_areas),
        Step("renewables_wide", ("renewable_cells",), renewables.combined_renewables),
        Step("carbon_intensity", ("intensity_rows",), normalise_columns),
        Step("carbon_bands", ("band_rows",), emissions.carbon_bands),
        *[
            Step(name, ("vehicle_rows",), partial(transport.latest_vehicles, period=period, breakdown=columns))
            for name, columns in breakdowns.items()
        ],
        Step("vehicle_mileage", ("mileage_cells",), transport.vehicle_mileage),
        Step("fuel_sectors", ("fuel_sector_rows",), energy.fuel_sector_lookup),
        Step("energy_by_fuel_and_sector", ("energy_long", "fuel_sectors"), energy.energy_by_fuel_sector),
        Step("station_generation", ("half_hourly_rows",), _stations),
    ]
