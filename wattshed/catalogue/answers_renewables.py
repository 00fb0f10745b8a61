"""Renewables: sheets, capacity, generation, planning sites, generators in a boundary."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.unions import union_strict
from ..plans import generation as ge
from ..plans import registry as rg
from ..plans import renewables as re
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import sinks as sk
from ..sources.records import read_features
from ..sources.sinks import read_published
from .base import query, rounded
from .inputs import REGION, REGION_CODES, grid_sql, with_ctes

_UNITS = "CASE type WHEN 'Sites' THEN 'number' WHEN 'Capacity' THEN 'mw' ELSE 'mwh' END"


for _whole in (False, True):

    @query(
        "renewables_long_whole" if _whole else "renewables_long",
        "P03", "PRJ-05", "PRJ-06", "SC-13", "SC-31", "UDF-04", "ST-01",
        sql=with_ctes("renewable_long")
        + f"""SELECT local_authority_code, year AS calendar_year, type, {_UNITS} AS units,
                     energy_source, count(*) AS n,
                     {'CAST(sum(CAST(value AS INTEGER)) AS BIGINT)' if _whole
                      else 'round(sum(value), 5)'} AS value
              FROM renewable_long GROUP BY 1, 2, 3, 4, 5""",
    )
    def _(t, whole=_whole):
        keys = ["local_authority_code", "calendar_year", "type", "units", "energy_source"]
        long = re.renewables_long(t.inputs.renewable_cells, round_to_int=whole)
        sums = long.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")
        )
        return rounded(sums, 5)


_MEASURE = """CASE type WHEN 'Sites' THEN 'sites_number' WHEN 'Capacity' THEN 'capacity_mw'
              ELSE 'generation_mwh' END"""


def _combined(t):
    return re.combined_renewables(t.inputs.renewable_cells)


@query(
    "renewables_combined_wide", "P24", "SRC-07", "SRC-08", "PRJ-08", "ST-02", "SC-06", "SC-07",
    "SC-18", "SNK-04",
    sql=with_ctes("renewable_wide")
    + f"""SELECT local_authority_name, year, {_MEASURE} AS measure,
                 count(*) AS n, count(photovoltaics) AS with_pv,
                 round(sum(photovoltaics), 5) AS photovoltaics,
                 round(sum(anaerobic_digestion), 5) AS anaerobic_digestion,
                 sum(wave_tidal) AS wave_tidal, sum(plant_biomass) AS plant_biomass,
                 sum(estimated_number_of_households) AS households
          FROM renewable_wide GROUP BY 1, 2, 3""",
)
def _(t):
    path = scratch_folder(t.spark, "renewables")
    sk.write_csv(_combined(t), path)
    text = de.read_csv_text(t.spark, path)
    number = lambda c: F.col(c).cast("double")
    sums = text.groupBy("local_authority_name", F.col("year").cast("int").alias("year"), "measure").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("photovoltaics").alias("with_pv"),
        F.sum(number("photovoltaics")).alias("photovoltaics"),
        F.sum(number("anaerobic_digestion")).alias("anaerobic_digestion"),
        F.sum(number("wave_tidal")).alias("wave_tidal"),
        F.sum(number("plant_biomass")).alias("plant_biomass"),
        F.sum(number("estimated_number_of_households")).alias("households"),
    )
    return rounded(sums, 5)


_TECH_SUM = " + ".join(f"coalesce(sum({c}), 0)" for c in re.TECHNOLOGIES)


def _years(t):
    return re.sheet_years(t.inputs.renewable_cells)


@query(
    "renewables_latest_capacity", "P22", "FLT-12", "RS-03", "FLT-07", "AG-01",
    sql=with_ctes("renewable_wide")
    + f"""SELECT round({_TECH_SUM}, 5) AS total_capacity FROM renewable_wide
          WHERE type = 'Capacity' AND local_authority_code IN
                ('E06000003', 'E06000008', 'E06000013', 'E06000018')
            AND year = (SELECT max(year) FROM renewable_wide)""",
)
def _(t):
    return rounded(re.latest_capacity_total(_combined(t), t.inputs.codes, _years(t)), 5)


@query(
    "renewables_latest_capacity_by_lookup", "P22", "JN-02", "RS-04", "AG-01",
    sql=with_ctes("renewable_wide")
    + f"""SELECT round({_TECH_SUM}, 5) AS total_capacity_mw FROM renewable_wide
          WHERE type = 'Capacity' AND local_authority_code IN {REGION_CODES}
            AND year = (SELECT max(year) FROM renewable_wide)""",
)
def _(t):
    return rounded(re.latest_capacity_by_lookup(_combined(t), t.inputs.ca_la, REGION, _years(t)), 5)


_LATEST_GEN = f"""SELECT local_authority_code, local_authority_name, year, energy_source, value
    FROM renewable_long WHERE type = 'Generation' AND energy_source <> 'total' AND value > 0
      AND year = (SELECT max(year) FROM renewable_long)
      AND local_authority_code IN {REGION_CODES}"""


def _by_source(t):
    return re.generation_by_source(
        re.renewables_long(t.inputs.renewable_cells), t.inputs.authorities, _years(t)
    )


@query(
    "generation_by_source", "P28", "FLT-11", "FLT-12", "FLT-15", "SC-04", "SC-16",
    sql=with_ctes("renewable_long", s=_LATEST_GEN)
    + """SELECT local_authority_name, year AS calendar_year,
                upper(energy_source[1]) || lower(replace(energy_source[2:], '_', ' ')) AS source,
                count(*) AS n, round(sum(value / 1000), 6) AS gen_gwh FROM s GROUP BY 1, 2, 3""",
)
def _(t):
    sums = _by_source(t).groupBy("local_authority_name", "calendar_year", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gen_gwh").alias("gen_gwh")
    )
    return rounded(sums, 6)


@query(
    "generation_total_latest", "P28", "AG-01",
    sql=with_ctes("renewable_long", s=_LATEST_GEN)
    + "SELECT round(sum(value / 1000), 6) AS total_gwh FROM s",
)
def _(t):
    return rounded(re.generation_total(_by_source(t)), 6)


@query(
    "generation_by_combined_authority", "P44", "JN-02", "RS-04", "AG-07", "SC-18", "SO-02",
    sql=with_ctes("renewable_wide")
    + f"""SELECT year, cauthnm, round({_TECH_SUM}, 5) AS total_generation,
                 CASE WHEN cauthnm = '{REGION}' THEN 'chosen' ELSE 'other' END AS highlight
          FROM renewable_wide JOIN ca_la ON local_authority_code = ladcd
          WHERE type = 'Generation' GROUP BY 1, 2 ORDER BY 3 DESC""",
)
def _(t):
    sums = re.generation_by_combined_authority(_combined(t), t.inputs.ca_la)
    marked = re.highlighted(sums, REGION)
    return rounded(marked, 5).orderBy(F.desc_nulls_last("total_generation"))


@query(
    "planning_sites_placed", "P04", "SRC-02", "SRC-03", "SC-32", "SC-33",
    sql=with_ctes("planning", **grid_sql("planning", "xcoordinate", "ycoordinate"))
    + """SELECT site_name, county, round(lon, 6) AS x, round(lat, 6) AS y, count(*) AS n
         FROM placed WHERE installed_capacity_mwelec IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def _(t):
    # Missing capacities are spoilt in the file, so those rows do not parse and drop.
    raw = t.inputs.planning.withColumn(
        "installed_capacity_mwelec", F.coalesce("installed_capacity_mwelec", F.lit("tbc"))
    )
    path = scratch_folder(t.spark, "planning")
    sk.write_csv(raw, path)
    schema = (
        "site_name string, operational string, technology_type string, "
        "installed_capacity_mwelec double, development_status_short string, county string, "
        "record_last_updated_ddmmyyyy string, storage_type string, share_community_scheme string, "
        "development_status string, planning_authority string, post_code string, "
        "xcoordinate double, ycoordinate double, o_orderkey bigint"
    )
    placed = re.planning_sites(de.read_csv_dropping(t.spark, path, schema).where(
        F.col("installed_capacity_mwelec").isNotNull()
    ))
    flat = placed.select(
        "site_name", "county", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y")
    )
    return rounded(flat, 6).groupBy("site_name", "county", "x", "y").agg(
        F.count(F.lit(1)).alias("n")
    )


_OPERATIONAL = """SELECT * FROM planning WHERE county IN ('NATION_3', 'NATION_8')
    AND installed_capacity_mwelec IS NOT NULL AND development_status_short = 'Operational'"""


def _operational(t):
    return re.operational_sites(t.inputs.planning, ["NATION_3", "NATION_8"])


@query(
    "planning_operational_sites", "P21", "SC-21", "SC-23", "PRJ-12", "FLT-04",
    sql=with_ctes("planning", o=_OPERATIONAL, **grid_sql("o", "xcoordinate", "ycoordinate"))
    + """SELECT site_name, operational_date, yr AS year, record_last_updated_ddmmyyyy,
                technology_type, storage_type,
                round(installed_capacity_mwelec, 6) AS installed_capacity_mwelec,
                share_community_scheme, development_status, planning_authority, county, post_code,
                round(xcoordinate, 6) AS bng_x, round(ycoordinate, 6) AS bng_y,
                round(lon, 6) AS lon, round(lat, 6) AS lat FROM placed""",
)
def _(t):
    sites = _operational(t).withColumns(
        {"lon": F.col("geo_point_2d.x"), "lat": F.col("geo_point_2d.y")}
    )
    return rounded(sites.drop("geo_point_2d"), 6)


@query(
    "planning_capacity_added", "P21", "FLT-13", "AG-01",
    sql=with_ctes("planning", o=_OPERATIONAL)
    + """SELECT round(sum(installed_capacity_mwelec), 6) AS capacity_added FROM o
         WHERE yr >= (SELECT max(yr) - 5 FROM o)""",
)
def _(t):
    return rounded(re.capacity_added(_operational(t)), 6)


@query(
    "community_energy_added", "P19", "SRC-10", "FLT-13", "AG-01",
    sql="""SELECT round(sum(o_totalprice / 1000), 5) AS k_wp_added FROM orders
           WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 5 FROM orders)""",
)
def _(t):
    sites = t.orders.select(
        F.year("o_orderdate").alias("year_installed"), (F.col("o_totalprice") / 1000).alias("k_wp")
    )
    path = scratch_folder(t.spark, "community")
    sk.write_csv(sites, path)
    landed = de.read_landed_extract(t.spark, path, "year_installed int, k_wp double")
    return rounded(re.community_energy_added(landed), 5)


# A boundary with a hole, in longitude and latitude.
BOUNDARY = [
    (
        "west",
        [
            [[-2.95, 51.25], [-2.35, 51.25], [-2.35, 51.6], [-2.95, 51.6], [-2.95, 51.25]],
            [[-2.7, 51.4], [-2.6, 51.4], [-2.6, 51.5], [-2.7, 51.5], [-2.7, 51.4]],
        ],
    )
]
_KINDS = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Fossil Fuel'
            WHEN '2-HIGH' THEN 'Small fossil plant' WHEN '3-MEDIUM' THEN NULL
            WHEN '4-NOT SPECIFIED' THEN 'Wind' ELSE 'Solar' END"""


def _generators(t):
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Fossil Fuel")
        .when(F.col("o_orderpriority") == "2-HIGH", "Small fossil plant")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Wind")
        .when(F.col("o_orderpriority") == "5-LOW", "Solar")
    )
    sites = t.inputs.planning.join(
        t.orders.select("o_orderkey", kind.alias("technology"), "o_totalprice"), "o_orderkey"
    )
    return sites.select(
        F.col("development_status_short").alias("type"),
        "technology",
        F.col("technology_type").alias("primary_fuel"),
        (F.col("o_totalprice") / 1000).cast("string").alias("installedcapacity_mw"),
        F.col("site_name").alias("postcode"),
        F.col("xcoordinate").cast("string").alias("xcoordinate"),
        F.col("ycoordinate").cast("string").alias("ycoordinate"),
    )


def _within(t):
    boundary = t.spark.createDataFrame(BOUNDARY, "area string, rings array<array<array<double>>>")
    return re.generators_within(_generators(t), boundary, "area", "rings", 0.1)


_EDGES = ", ".join(
    f"({ring[i][0]}, {ring[i][1]}, {ring[i + 1][0]}, {ring[i + 1][1]})"
    for ring in BOUNDARY[0][1]
    for i in range(len(ring) - 1)
)
_WITHIN = with_ctes(
    "planning",
    k=f"""SELECT planning.*, o_totalprice / 1000 AS capacity, {_KINDS} AS technology
          FROM planning JOIN orders USING (o_orderkey)""",
    **grid_sql("k", "xcoordinate", "ycoordinate"),
    e=f"SELECT x1::DOUBLE x1, y1::DOUBLE y1, x2::DOUBLE x2, y2::DOUBLE y2 "
    f"FROM (VALUES {_EDGES}) v(x1, y1, x2, y2)",
    crossed="""SELECT o_orderkey, sum(CASE WHEN (y1 > lat) <> (y2 > lat) THEN
                  CASE WHEN lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END
                  ELSE 0 END) AS c FROM placed, e GROUP BY 1""",
    w="SELECT placed.* FROM placed JOIN crossed USING (o_orderkey) WHERE c % 2 = 1",
)


@query(
    "generators_in_boundary", "P23", "JN-07",
    sql=_WITHIN
    + """SELECT development_status_short AS type, technology, technology_type AS primary_fuel,
                capacity, site_name AS postcode, round(lon, 6) AS lon, round(lat, 6) AS lat
         FROM w""",
)
def _(t):
    return _within(t).drop("area").withColumns(
        {"lon": F.round("lon", 6), "lat": F.round("lat", 6)}
    )


@query(
    "generators_fossil_and_renewable", "P23", "AG-14", "FLT-03",
    sql=_WITHIN
    + """SELECT 'Fossil' AS category,
                round(sum(CASE WHEN technology ILIKE '%fossil%' THEN capacity END), 5) AS capacity
         FROM w UNION ALL SELECT 'Renewable', round(sum(o_totalprice / 1000), 5) FROM orders""",
)
def _(t):
    renewable = t.orders.agg(F.sum(F.col("o_totalprice") / 1000).alias("x"))
    return rounded(re.fossil_and_renewable(_within(t), renewable), 5)


@query(
    "generators_summary", "P23", "AG-09", "AG-14", "PRJ-12", "SC-14",
    sql=_WITHIN
    + """SELECT fuel_category, round(c, 1) AS installed_capacity_mw,
                round(round(c, 1) * 100 / (SELECT sum(capacity) FROM w), 1) AS proportion_of_total
         FROM (SELECT CASE WHEN technology = 'Fossil Fuel' THEN 'Fossil' ELSE 'Renewable' END
                      AS fuel_category, sum(capacity) AS c FROM w GROUP BY 1)""",
)
def _(t):
    return re.energy_source_summary(_within(t))


_SUMS = "round(sum(capacity), 2) AS capacity, round(sum(lon), 2) AS lon, round(sum(lat), 2) AS lat"


@query(
    "generators_exported", "P23", "SNK-01", "SNK-04", "SNK-06", "SNK-07",
    sql=_WITHIN
    + f"""SELECT 'table' AS output, technology, count(*) AS n, {_SUMS} FROM w GROUP BY 2
          UNION ALL SELECT 'csv', technology, count(*), {_SUMS} FROM w GROUP BY 2
          UNION ALL SELECT 'features', technology, count(*), {_SUMS} FROM placed GROUP BY 2
          UNION ALL SELECT 'sources', 'Fossil', 1,
              round(sum(CASE WHEN technology ILIKE '%fossil%' THEN capacity END), 2), NULL, NULL FROM w
          UNION ALL SELECT 'sources', 'Renewable', 1, round(sum(o_totalprice / 1000), 2), NULL, NULL
              FROM orders
          UNION ALL SELECT 'summary', fuel_category, 1, round(c, 1), NULL, NULL FROM (
              SELECT CASE WHEN technology = 'Fossil Fuel' THEN 'Fossil' ELSE 'Renewable' END
                     AS fuel_category, sum(capacity) AS c FROM w GROUP BY 1)""",
)
def _(t):
    """Every output of the report: features of all generators, a table, and three CSV files, each read back."""
    spark, folder = t.spark, scratch_folder(t.spark, "generators")
    renewable = t.orders.agg(F.sum(F.col("o_totalprice") / 1000).alias("x"))
    boundary = spark.createDataFrame(BOUNDARY, "area string, rings array<array<array<double>>>")
    table = f"generators_within_{uuid.uuid4().hex}"
    re.export_generators(_generators(t), boundary, "area", "rings", 0.1, renewable, folder, table)
    kept = "type string, technology string, primary_fuel string, capacity double, postcode string"
    found = {
        "table": spark.table(table),
        "csv": de.read_csv(spark, f"{folder}/generators_within", f"{kept}, lon double, lat double"),
        "features": read_features(spark, f"{folder}/generators", kept, "Point", collection=False).withColumns(
            {"lon": F.col("coordinates")[0], "lat": F.col("coordinates")[1]}
        ),
        "sources": de.read_csv(spark, f"{folder}/renewables_fossil", "technology string, capacity double"),
        "summary": de.read_csv(
            spark, f"{folder}/energy_source_summary", "technology string, capacity double, share double"
        ),
    }
    out = []
    for name, df in found.items():
        missing = {c: F.lit(None).cast("double") for c in ("lon", "lat") if c not in df.columns}
        sums = [F.sum(c).alias(c) for c in ("capacity", "lon", "lat")]
        grouped = df.withColumns(missing).groupBy("technology").agg(F.count(F.lit(1)).alias("n"), *sums)
        out.append(grouped.select(F.lit(name).alias("output"), "technology", "n", "capacity", "lon", "lat"))
    return rounded(union_strict(out), 2)


def _station(t, **more):
    raw = t.inputs.readings
    return ge.station_generation(raw.toDF(*[c.lower() for c in raw.columns]), **more)


@query(
    "station_generation", "P16", "PRJ-02", "PRJ-04",
    sql=with_ctes("readings")
    + """SELECT bmunit, settlementperiod, halfhourendtime, quantity AS generation_mwh
         FROM readings""",
)
def _(t):
    return _station(t, keep_settlement_date=False)


@query(
    "station_daily", "P29", "AG-15",
    sql=with_ctes("readings")
    + """SELECT CAST(halfhourendtime AS DATE) AS date, bmunit,
                round(sum(quantity), 2) AS generation_mwh FROM readings GROUP BY 1, 2""",
)
def _(t):
    return rounded(ge.station_daily(_station(t)), 2)


@query(
    "station_year", "P29", "AG-01", "AG-05",
    sql=with_ctes("readings")
    + """SELECT round(sum(quantity) / 1000, 5) AS generation_gwh,
                CAST(year(min(halfhourendtime)) AS INTEGER) AS year FROM readings""",
)
def _(t):
    return rounded(ge.station_year(_station(t)), 5)


@query(
    "station_percent_renewable", "P29", "AG-19",
    sql=with_ctes("renewable_long", "readings", s=_LATEST_GEN)
    + """SELECT round_even(r * 100 / (r + f), 0) AS percent_renewable_generation
         FROM (SELECT (SELECT sum(value / 1000) FROM s) AS r,
                      (SELECT sum(quantity) / 1000 FROM readings) AS f)""",
)
def _(t):
    return ge.percent_renewable(_by_source(t), ge.station_year(_station(t)))


@query(
    "build_registered_tables", "UDF-03", "SNK-09",
    sql=with_ctes("renewable_long")
    + """SELECT energy_source, round(sum(value), 4) AS value,
                round(sum(value) / (SELECT sum(value) FROM renewable_long), 6) AS share
         FROM renewable_long GROUP BY 1""",
)
def _(t):
    """Two registered steps, the second over what the first made, published together."""
    steps = [
        rg.Step("renewables_long", ("cells",), re.renewables_long),
        rg.Step("technology_shares", ("renewables_long",), re.technology_shares),
    ]
    root = scratch_folder(t.spark, "build")
    rg.run(t.spark, steps, {"cells": t.inputs.renewable_cells}, root)
    shares = read_published(t.spark, root, "technology_shares")
    return shares.withColumns({"value": F.round("value", 4), "share": F.round("share", 6)})
