"""The build of all named tables in one run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.unions import union_strict
from ..plans import registry as rg
from ..plans import tables as tb
from ..session import scratch_folder
from ..sources import records as rc
from ..sources import sinks as sk
from . import answers_buildings as bu
from . import answers_energy as en
from . import answers_places as pl
from . import answers_transport as tr
from .base import query
from .inputs import with_ctes


def _inputs(t):
    """What each table is made from, landed as files."""
    root, spark = scratch_folder(t.spark, "build-inputs"), t.spark
    value = F.when(F.col("n") > 1, F.col("n").cast("string")).otherwise("[c]")
    heads = F.col("n") * 12.5
    charging = tr._quarter_cells(t, "1a", "Local authority / region code", value).unionByName(
        tr._quarter_cells(t, "2a", "Local authority / region code \n[Note 5]", heads.cast("string"))
    )
    intensity = t.events.select(
        F.col("event_type").alias("Region Name"), F.col("value").alias("Intensity (gCO2/kWh)")
    )
    bands = t.nation.select(F.col("n_name").alias("band"), F.col("n_nationkey").alias("very_high_upper_limit"))
    landed = {
        "electricity_cells": en.electricity_cells(t),
        "energy_cells": t.inputs.energy_cells,
        "renewable_cells": t.inputs.renewable_cells,
        "planning_register": t.inputs.planning,
        "charging_cells": charging,
        "vehicle_rows": tr._vehicles(t),
        "poverty_cells": bu._poverty_cells(t),
        "lookup_cells": bu._lookup_cells(t),
        "band_rows": bands,
        "mileage_cells": tr.mileage_cells(t),
        "fuel_sector_rows": t.inputs.fuel_sectors,
        "half_hourly_rows": t.inputs.readings,
    }
    found = {}
    for name, df in landed.items():
        sk.write_parquet(df, f"{root}/{name}")
        found[name] = spark.read.parquet(f"{root}/{name}")
    sk.write_csv(intensity, f"{root}/intensity")
    found["intensity_rows"] = spark.read.option("header", True).csv(f"{root}/intensity")
    areas = pl._areas(t).drop("c_nationkey")
    for name, rows in (("area_features", areas), ("boundary_features", areas.where("c_custkey % 3 = 1"))):
        sk.write_area_features(rows, f"{root}/{name}")
        found[name] = rc.read_areas(spark, f"{root}/{name}", pl._PROPERTIES, collection=False)
    return found


_FUELS = "FROM vehicles WHERE _2025_q1 IS NOT NULL AND substr(lsoa11cd, 1, 1) = 'E' AND fuel <> 'Total'"
_BODIES = """FROM vehicles WHERE _2025_q1 IS NOT NULL AND substr(lsoa11cd, 1, 1) = 'E'
             AND bodytype <> 'Total' AND keepership <> 'Total' AND licencestatus <> 'Total'"""
_COUNTS = {
    "electricity": "FROM energy_wide WHERE code LIKE 'E0%'",
    "energy_long": "FROM energy_long WHERE code LIKE 'E0%'",
    "renewables_long": "FROM renewable_long",
    "planning_sites": "FROM planning",
    "charge_points": "FROM i WHERE n > 1 AND ladcd LIKE 'E0%'",
    "charge_points_per_head": "FROM i WHERE ladcd LIKE 'E0%'",
    "authority_areas": "FROM rings",
    "region_boundary": "FROM rings WHERE c_custkey % 3 = 1",
    "electric_registrations": """FROM vehicles WHERE _2025_q1 IS NOT NULL
        AND (fuel = 'Battery electric' OR fuel LIKE 'Plug%')""",
    "fuel_poverty": "FROM customers",
    "small_areas": "FROM customers",
    "renewables_wide": "FROM renewable_wide",
    "carbon_intensity": "FROM events",
    "carbon_bands": "FROM nation",
    "vehicles_by_fuel": _FUELS,
    "company_vehicles_by_fuel": _FUELS,
    "vehicles_by_body_keeper_and_status": _BODIES,
    "vehicle_mileage": "FROM (SELECT DISTINCT c_custkey, ladcd, yr FROM order_sites) WHERE ladcd LIKE 'E0%'",
    "fuel_sectors": "FROM fuel_sectors",
    "energy_by_fuel_and_sector": "FROM energy_view",
    "station_generation": "FROM readings",
}


@query(
    "build_all_tables", "UDF-03", "SNK-09",
    sql=with_ctes(
        "energy_view", "renewable_long", "planning", "vehicles", "readings", i=tr._INSTALLS, rings=pl._RINGS
    )
    + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, true AS taken_over {rows}" for name, rows in _COUNTS.items()
    ),
)
def _(t):
    """The whole set, built and published; a second run finds nothing changed and takes every table over."""
    steps, inputs = tb.registered("_2025_q1", ["c_custkey", "lad_name"]), _inputs(t)
    root = scratch_folder(t.spark, "all-tables")
    first = rg.run(t.spark, steps, inputs, root)
    rg.run(t.spark, steps, inputs, root)
    out = []
    for step in steps:
        table = sk.read_published(t.spark, root, step.name)
        kept = F.lit(all(f"run={first}/" in f for f in table.inputFiles())).alias("taken_over")
        out.append(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step.name).alias("name"), "n", kept))
    return union_strict(out)
