"""Domain-shaped inputs derived from the test tables, and the same in SQL.

The statistics files are not part of the test tables, so orders stand in for
worksheet rows, line items for energy certificates and emission records,
customers for small areas, events for half-hourly readings. Every derivation
runs over its whole table, so the work grows with the data.
"""

from __future__ import annotations

import struct
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geography as geo
from .base import Tables

REGION = "EUROPE"
ENERGY_COLUMNS = [
    "all_fuels_domestic",
    "all_fuels_industrial_commercial_and_other",
    "all_fuels_transport",
    "all_fuels_total",
    "electricity_total",
    "gas_total",
    "petroleum_total",
    "coal_total",
    "manufactured_fuels_unlisted",
]
FUEL_SECTORS = [
    ("all_fuels_domestic", "all_fuels", "domestic"),
    (
        "all_fuels_industrial_commercial_and_other",
        "all_fuels",
        "industrial_commercial_and_other",
    ),
    ("all_fuels_transport", "all_fuels", "transport"),
    ("all_fuels_total", "all_fuels", "total"),
    ("electricity_total", "electricity", "total"),
    ("gas_total", "gas", "total"),
    ("petroleum_total", "petroleum", "total"),
    ("coal_total", "coal", "total"),
]
HEATING_PHRASES = {
    "ECONOMY": "Boiler and radiators, mains gas",
    "SMALL": "Room heaters, electric",
    "MEDIUM": "Air source heat pump, radiators, electric",
    "PROMO": "Boiler and radiators, oil",
    "STANDARD": "Community scheme",
    "LARGE": "Boiler & radiators | LPG",
}
LAST_DAY = "2000-06-30"


def stage(
    rows: DataFrame, sheet: Column, row: Column, header_row: int | Column, cells: dict[str, Column]
) -> DataFrame:
    """Rows to staged cells, plus one header row for each sheet; NULL cells are absent."""
    body = rows.select(
        sheet.alias("sheet"),
        row.cast("bigint").alias("row"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i + 1).alias("col"), v.cast("string").alias("value"))
                    for i, v in enumerate(cells.values())
                ]
            )
        ),
    ).where(F.col("value").isNotNull())
    at = F.lit(header_row) if isinstance(header_row, int) else header_row
    heads = (
        rows.select(sheet.alias("sheet"))
        .distinct()
        .select(
            "sheet",
            at.cast("bigint").alias("row"),
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(i + 1).alias("col"), F.lit(h).alias("value"))
                        for i, h in enumerate(cells)
                    ]
                )
            ),
        )
    )
    return body.unionByName(heads).withColumn("workbook", F.lit("book"))


@F.arrow_udf(T.BinaryType())
def triangle_wkb(*xy: pa.Array) -> pa.Array:
    """A polygon of one closed ring of four corners, in the bytes of WKB."""
    body = np.stack([v.to_numpy(zero_copy_only=False).astype("<f8") for v in xy], axis=1)
    head = np.frombuffer(struct.pack("<BIII", 1, 3, 1, 4), dtype=np.uint8)
    raw = np.concatenate([np.tile(head, (len(body), 1)), body.view(np.uint8).reshape(len(body), -1)], axis=1)
    offsets = np.arange(len(body) + 1, dtype=np.int32) * raw.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(body), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


def choose(c: Column, options: dict[str, str], otherwise: str | None = None) -> Column:
    pairs = list(options.items())
    rule = F.when(c == pairs[0][0], pairs[0][1])
    for key, value in pairs[1:]:
        rule = rule.when(c == key, value)
    return rule.otherwise(otherwise)


class Inputs:
    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def ca_la(self) -> DataFrame:
        t = self.t
        prefix = F.when(F.col("r_name") == "MIDDLE EAST", "W").otherwise("E")
        number = F.lpad((F.col("n_nationkey") + 6000000).cast("string"), 8, "0")
        return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.concat(prefix, number).alias("ladcd"),
            F.col("n_name").alias("ladnm"),
            F.concat(F.lit("E4700000"), F.col("n_regionkey").cast("string")).alias("cauthcd"),
            F.col("r_name").alias("cauthnm"),
            "n_nationkey",
        )

    @cached_property
    def authorities(self) -> DataFrame:
        """The authorities of the region the report is about."""
        return self.ca_la.where(F.col("cauthnm") == REGION).select("ladcd", "ladnm")

    @cached_property
    def codes(self) -> list[str]:
        return ["E06000003", "E06000008", "E06000013", "E06000018"]

    @cached_property
    def customers(self) -> DataFrame:
        return self.t.customer.join(
            self.ca_la.drop("cauthcd"), F.col("c_nationkey") == F.col("n_nationkey")
        )

    @cached_property
    def order_sites(self) -> DataFrame:
        orders = self.t.orders.withColumn("yr", F.year("o_orderdate"))
        return orders.join(self.customers, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def energy_cells(self) -> DataFrame:
        price, status, priority = (
            F.col("o_totalprice"),
            F.col("o_orderstatus"),
            F.col("o_orderpriority"),
        )
        half = (price * 0.5).cast("string")
        cells = {
            "Country or region": F.col("cauthnm"),
            "Local authority": F.col("ladnm"),
            "Code": F.col("ladcd"),
            "Notes": status,
            "All fuels: Domestic": price * 0.25,
            "All fuels: Industrial, Commercial and other": F.when(status != "P", price * 0.25),
            "All fuels: Transport [note 3]": price * 0.5,
            "All fuels: Total": price,
            "Electricity: Total [note 1] [note 2]": F.when(
                priority.isin("1-URGENT", "2-HIGH"), half
            ).otherwise("[c]"),
            "Gas: Total": F.when(priority == "3-MEDIUM", half).otherwise("[x]"),
            "Petroleum: Total": F.when(priority == "4-NOT SPECIFIED", half).otherwise("[c]"),
            "Coal: Total": F.when(priority == "5-LOW", half).otherwise("[c]"),
            "Manufactured fuels: Unlisted": price * 0.25,
        }
        return stage(
            self.order_sites, F.col("yr").cast("string"), F.col("o_orderkey") + 7, 6, cells
        )

    @cached_property
    def fuel_sectors(self) -> DataFrame:
        return self.t.spark.createDataFrame(
            FUEL_SECTORS, "original_string string, fuel string, sector string"
        )

    @cached_property
    def renewable_cells(self) -> DataFrame:
        mw = F.col("o_totalprice") / 1000
        priority = F.col("o_orderpriority")
        kind = choose(
            F.col("o_orderstatus"), {"F": "Generation", "O": "Capacity"}, "Sites"
        )
        sheet = F.concat(
            F.lit("LA - "),
            kind,
            F.when(kind == "Sites", " ").otherwise(", "),
            F.col("yr").cast("string"),
        )
        zero = F.lit("0")
        cells = {
            "Local Authority Code": F.col("ladcd"),
            "Local Authority Name": F.col("ladnm"),
            "Estimated number of households [note 1]": F.col("o_custkey"),
            "Region": F.col("cauthnm"),
            "Country": F.lit("England"),
            "Photovoltaics": F.when(priority == "1-URGENT", mw.cast("string")).otherwise("[c]"),
            "Onshore Wind": F.when(priority == "2-HIGH", mw),
            "Hydro": F.when(priority == "3-MEDIUM", mw),
            "Anaerobic Digestion [note 5] [note 6]": F.when(priority == "4-NOT SPECIFIED", mw),
            "Offshore Wind": zero,
            "Wave Tidal": zero,
            "Sewage Gas": zero,
            "Landfill Gas": F.when(priority == "5-LOW", mw),
            "Municipal Solid Waste": zero,
            "Animal Biomass": zero,
            "Plant Biomass": F.lit("[x]"),
            "Cofiring": zero,
            "Total": mw,
        }
        header = F.when(F.col("sheet").contains("Generation"), 5).otherwise(4)
        return stage(self.order_sites, sheet, F.col("o_orderkey") + 7, header, cells)

    @cached_property
    def certificates(self) -> DataFrame:
        t = self.t
        phrase = choose(F.col("p_type"), HEATING_PHRASES)
        second = F.when(F.col("p_size") > 40, " and room heaters, electric").otherwise("")
        text = F.concat(phrase, F.lit(", "), F.col("p_name"), second)
        return (
            t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.ca_la, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("ladcd").alias("local_authority"),
                F.col("ladnm").alias("local_authority_label"),
                F.when(F.col("l_tax") != 0.08, text).alias("mainheat_description"),
                F.to_date("l_shipdate").alias("lodgement_date"),
                F.col("l_returnflag").alias("current_energy_rating"),
                F.col("l_linestatus").alias("construction_epoch"),
            )
        )

    @cached_property
    def emissions(self) -> DataFrame:
        t = self.t
        sector = choose(F.col("l_returnflag"), {"A": "Transport", "N": "Domestic"}, "Industry")
        lost = (F.col("ladnm") == "NATION_8") & (sector == "Transport") & (F.col("l_tax") == 0.08)
        return (
            t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.ca_la, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("ladnm").alias("local_authority"),
                F.col("ladcd").alias("local_authority_code"),
                sector.alias("la_ghg_sector"),
                F.year("l_shipdate").alias("calendar_year"),
                F.when(~lost, F.col("l_extendedprice")).alias("territorial_emissions_kt_co2e"),
            )
        )

    @cached_property
    def readings(self) -> DataFrame:
        """One reading for each unit, day and half-hour that has events."""
        day = F.to_date("ts")
        period = F.hour("ts") * 2 + F.when(F.minute("ts") >= 30, 2).otherwise(1)
        keyed = self.t.events.select(
            F.concat(F.lit("T_"), F.upper("event_type"), F.lit("-"), "user_id").alias("bmUnit"),
            day.alias("settlementDate"),
            period.cast("int").alias("settlementPeriod"),
            "value",
        )
        sums = keyed.groupBy("bmUnit", "settlementDate", "settlementPeriod").agg(
            F.round(F.sum("value"), 2).alias("quantity")
        )
        end = F.timestamp_add(
            "MINUTE", F.col("settlementPeriod") * 30, F.col("settlementDate").cast("timestamp_ntz")
        )
        return sums.select(
            F.lit("B1610").alias("dataset"),
            F.lit("Generation").alias("psrType"),
            "bmUnit",
            F.replace("bmUnit", F.lit("T_"), F.lit("")).alias("nationalGridBmUnitId"),
            "settlementDate",
            "settlementPeriod",
            end.alias("halfHourEndTime"),
            "quantity",
        )

    @cached_property
    def planning(self) -> DataFrame:
        capacity = (F.col("o_totalprice") / 10000).cast("string")
        return self.order_sites.select(
            F.col("c_name").alias("site_name"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("operational"),
            F.col("c_mktsegment").alias("technology_type"),
            F.when(F.col("o_orderpriority") != "5-LOW", capacity).alias(
                "installed_capacity_mwelec"
            ),
            choose(
                F.col("o_orderstatus"), {"F": "Operational", "O": "Planning"}, "Construction"
            ).alias("development_status_short"),
            F.col("ladnm").alias("county"),
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("record_last_updated_ddmmyyyy"),
            F.when(F.col("o_orderstatus") == "F", "Battery").alias("storage_type"),
            F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No").alias("share_community_scheme"),
            F.concat(F.lit("Status "), F.col("o_orderstatus")).alias("development_status"),
            F.concat("ladnm", F.lit(" Council")).alias("planning_authority"),
            F.concat(F.lit("AB"), F.col("c_custkey")).alias("post_code"),
            (F.col("o_totalprice") / 10 + 330000).alias("xcoordinate"),
            (F.col("c_acctbal") * 4 + 150000).alias("ycoordinate"),
            "o_orderkey",
        )

    @cached_property
    def vehicles(self) -> DataFrame:
        """Rows as a licensing file has them, headers included."""
        fuel = choose(
            F.col("c_mktsegment"),
            {
                "AUTOMOBILE": "Battery electric",
                "BUILDING": "Plug-in hybrid electric (petrol)",
                "FURNITURE": "Petrol",
                "MACHINERY": "Diesel",
            },
            "Total",
        )
        count = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise("[c]")
        code = F.concat(
            F.substring("ladcd", 1, 1),
            F.lit("01"),
            F.format_string("%06d", F.col("c_custkey")),
        )
        return self.customers.select(
            code.alias("LSOA11CD"),
            F.col("c_name").alias("LSOA11NM"),
            fuel.alias("Fuel"),
            F.when(F.col("c_acctbal") > 5000, "Total").otherwise("Cars").alias("Body-Type"),
            F.when(F.col("c_acctbal") > 1000, "Private").otherwise("Company").alias("Keepership"),
            F.when(F.col("c_custkey") % 3 == 0, "Total")
            .when(F.col("c_custkey") % 3 == 1, "Licensed")
            .otherwise("SORN")
            .alias("Licence-Status"),
            count.alias("2025 Q1"),
        )


# --- the same in SQL, as the bodies of common table expressions ---

_PHRASE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HEATING_PHRASES.items())

CTES = {
    "ca_la": """
        SELECT CASE WHEN r_name = 'MIDDLE EAST' THEN 'W' ELSE 'E' END
               || lpad(CAST(6000000 + n_nationkey AS VARCHAR), 8, '0') AS ladcd,
               n_name AS ladnm, 'E4700000' || CAST(n_regionkey AS VARCHAR) AS cauthcd,
               r_name AS cauthnm, n_nationkey
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT * FROM customer JOIN ca_la ON c_nationkey = n_nationkey""",
    "order_sites": """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr
        FROM orders JOIN customers ON o_custkey = c_custkey""",
    "energy_wide": """
        SELECT cauthnm AS country_or_region, ladnm AS local_authority, ladcd AS code,
               yr AS calendar_year, o_orderkey,
               o_totalprice * 0.25 AS all_fuels_domestic,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 0.25 END
                   AS all_fuels_industrial_commercial_and_other,
               o_totalprice * 0.5 AS all_fuels_transport,
               o_totalprice AS all_fuels_total,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice * 0.5 END
                   AS electricity_total,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice * 0.5 END AS gas_total,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice * 0.5 END
                   AS petroleum_total,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice * 0.5 END AS coal_total,
               o_totalprice * 0.25 AS manufactured_fuels_unlisted
        FROM order_sites""",
    # Suppressed cells stay as NULL rows; absent cells are no rows.
    "energy_long": """
        SELECT country_or_region, local_authority, code, calendar_year, fuel_sector, ktoe
        FROM energy_wide UNPIVOT INCLUDE NULLS (ktoe FOR fuel_sector IN (
            all_fuels_domestic, all_fuels_industrial_commercial_and_other, all_fuels_transport,
            all_fuels_total, electricity_total, gas_total, petroleum_total, coal_total,
            manufactured_fuels_unlisted))
        WHERE NOT (fuel_sector = 'all_fuels_industrial_commercial_and_other' AND ktoe IS NULL)""",
    "fuel_sectors": "SELECT * FROM (VALUES "
    + ", ".join(
        "('{}', '{}', '{}')".format(
            k,
            f[:1].upper() + f[1:].replace("_", " "),
            s[:1].upper() + s[1:].replace("_", " "),
        )
        for k, f, s in FUEL_SECTORS
    )
    + ") AS v(fuel_sector, fuel, sector)",
    "energy_view": """
        SELECT country_or_region, code AS ladcd, local_authority AS ladnm, ktoe, calendar_year,
               fuel, sector
        FROM energy_long JOIN fuel_sectors USING (fuel_sector) WHERE code LIKE 'E0%'""",
    "renewable_wide": """
        SELECT ladcd AS local_authority_code, ladnm AS local_authority_name,
               CAST(o_custkey AS DOUBLE) AS estimated_number_of_households,
               cauthnm AS region, 'England' AS country,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1000 END AS photovoltaics,
               CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice / 1000 END AS onshore_wind,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 1000 END AS hydro,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice / 1000 END
                   AS anaerobic_digestion,
               CAST(0 AS DOUBLE) AS offshore_wind, CAST(0 AS DOUBLE) AS wave_tidal,
               CAST(0 AS DOUBLE) AS sewage_gas,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice / 1000 END AS landfill_gas,
               CAST(0 AS DOUBLE) AS municipal_solid_waste, CAST(0 AS DOUBLE) AS animal_biomass,
               CAST(NULL AS DOUBLE) AS plant_biomass, CAST(0 AS DOUBLE) AS cofiring,
               o_totalprice / 1000 AS total,
               yr AS year,
               CASE o_orderstatus WHEN 'F' THEN 'Generation' WHEN 'O' THEN 'Capacity'
                    ELSE 'Sites' END AS type
        FROM order_sites WHERE ladcd LIKE 'E0%'""",
    "renewable_long": """
        SELECT * FROM (UNPIVOT renewable_wide
              ON COLUMNS(* EXCLUDE (local_authority_code, local_authority_name,
                                    estimated_number_of_households, region, country, year, type))
              INTO NAME energy_source VALUE value)""",
    "certificates": f"""
        SELECT ladcd AS local_authority, ladnm AS local_authority_label,
               CASE WHEN l_tax <> 0.08 THEN
                   CASE p_type {_PHRASE_SQL} END || ', ' || p_name
                   || CASE WHEN p_size > 40 THEN ' and room heaters, electric' ELSE '' END
               END AS mainheat_description,
               CAST(l_shipdate AS DATE) AS lodgement_date, l_returnflag AS current_energy_rating,
               l_linestatus AS construction_epoch
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN ca_la ON s_nationkey = n_nationkey""",
    "emissions": """
        SELECT *, CASE WHEN NOT (local_authority = 'NATION_8' AND la_ghg_sector = 'Transport'
                                 AND l_tax = 0.08) THEN l_extendedprice END
               AS territorial_emissions_kt_co2e
        FROM (SELECT ladnm AS local_authority, ladcd AS local_authority_code,
                     CASE l_returnflag WHEN 'A' THEN 'Transport' WHEN 'N' THEN 'Domestic'
                          ELSE 'Industry' END AS la_ghg_sector,
                     CAST(year(l_shipdate) AS INTEGER) AS calendar_year, l_tax, l_extendedprice
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                   JOIN ca_la ON s_nationkey = n_nationkey)""",
    "readings": """
        SELECT bmunit, settlementdate, settlementperiod, quantity,
               CAST(settlementdate AS TIMESTAMP) + settlementperiod * INTERVAL 30 MINUTE
                   AS halfhourendtime
        FROM (SELECT 'T_' || upper(event_type) || '-' || user_id AS bmunit, CAST(ts AS DATE) AS settlementdate,
                     CAST(hour(ts) * 2 + CASE WHEN minute(ts) >= 30 THEN 2 ELSE 1 END AS INTEGER)
                         AS settlementperiod, round(sum(value), 2) AS quantity
              FROM events GROUP BY 1, 2, 3)""",
    "planning": """
        SELECT c_name AS site_name, CAST(o_orderdate AS DATE) AS operational_date,
               c_mktsegment AS technology_type,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 10000 END
                   AS installed_capacity_mwelec,
               CASE o_orderstatus WHEN 'F' THEN 'Operational' WHEN 'O' THEN 'Planning'
                    ELSE 'Construction' END AS development_status_short,
               ladnm AS county, strftime(o_orderdate, '%d/%m/%Y') AS record_last_updated_ddmmyyyy,
               CASE o_orderstatus WHEN 'F' THEN 'Battery' END AS storage_type,
               CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS share_community_scheme,
               'Status ' || o_orderstatus AS development_status,
               ladnm || ' Council' AS planning_authority, 'AB' || c_custkey AS post_code,
               o_totalprice / 10 + 330000 AS xcoordinate,
               c_acctbal * 4 + 150000 AS ycoordinate, o_orderkey, yr
        FROM order_sites""",
    "vehicles": """
        SELECT substr(ladcd, 1, 1) || '01' || printf('%06d', c_custkey) AS lsoa11cd,
               c_name AS lsoa11nm,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Battery electric'
                    WHEN 'BUILDING' THEN 'Plug-in hybrid electric (petrol)'
                    WHEN 'FURNITURE' THEN 'Petrol' WHEN 'MACHINERY' THEN 'Diesel'
                    ELSE 'Total' END AS fuel,
               CASE WHEN c_acctbal > 5000 THEN 'Total' ELSE 'Cars' END AS bodytype,
               CASE WHEN c_acctbal > 1000 THEN 'Private' ELSE 'Company' END AS keepership,
               CASE c_custkey % 3 WHEN 0 THEN 'Total' WHEN 1 THEN 'Licensed' ELSE 'SORN' END
                   AS licencestatus,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS _2025_q1
        FROM customers""",
}

# Each body's own needs, in order.
_NEEDS = {
    "customers": ["ca_la"],
    "order_sites": ["customers"],
    "energy_wide": ["order_sites"],
    "energy_long": ["energy_wide"],
    "energy_view": ["energy_long", "fuel_sectors"],
    "renewable_wide": ["order_sites"],
    "renewable_long": ["renewable_wide"],
    "certificates": ["ca_la"],
    "emissions": ["ca_la"],
    "planning": ["order_sites"],
    "vehicles": ["customers"],
}


def with_ctes(*names: str, **more: str) -> str:
    """``WITH ...`` of the named bodies and all they need, then any given bodies."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    bodies = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({b})" for n, b in more.items()]
    return "WITH " + ",\n".join(bodies) + "\n"


REGION_CODES = f"(SELECT ladcd FROM ca_la WHERE cauthnm = '{REGION}')"


def grid_sql(source: str, easting: str, northing: str) -> dict[str, str]:
    """Bodies ``placed`` and its steps: the source's columns plus lon and lat."""
    g = geo
    a0, a1, a2, a3 = g.ARC
    af = g.AIRY_A * g.SCALE

    def arc(v: str) -> str:
        d, s = f"({v} - {g.LAT0!r})", f"({v} + {g.LAT0!r})"
        return (
            f"({g.AIRY_B * g.SCALE!r} * ({a0!r} * {d} - {a1!r} * sin({d}) * cos({s})"
            f" + {a2!r} * sin(2 * {d}) * cos(2 * {s}) - {a3!r} * sin(3 * {d}) * cos(3 * {s})))"
        )

    north = f"({northing} - {g.N0!r})"
    steps = {
        "g0": f"SELECT *, {g.LAT0!r} + {north} / {af!r} AS la FROM {source}",
    }
    for i in range(g.ARC_STEPS):
        steps[f"g{i + 1}"] = (
            f"SELECT * REPLACE (la + ({north} - {arc('la')}) / {af!r} AS la) FROM g{i}"
        )
    steps["g6"] = (
        f"SELECT *, {af!r} / sqrt(1 - {g.AIRY_E2!r} * sin(la) * sin(la)) AS nu,"
        f" {af!r} * (1 - {g.AIRY_E2!r}) / pow(1 - {g.AIRY_E2!r} * sin(la) * sin(la), 1.5) AS rho,"
        f" tan(la) AS t, {easting} - {g.E0!r} AS de FROM g5"
    )
    steps["g7"] = "SELECT *, de / nu AS u, nu / rho - 1 AS eta2, t * t AS t2 FROM g6"
    steps["g8"] = (
        "SELECT *, la - (t * nu / rho) * (pow(u,2)/2 - pow(u,4)/24*(5 + 3*t2 + eta2 - 9*t2*eta2)"
        " + pow(u,6)/720*(61 + 90*t2 + 45*t2*t2)) AS alat,"
        f" {g.LON0!r} + (1/cos(la)) * (u - pow(u,3)/6*(nu/rho + 2*t2)"
        " + pow(u,5)/120*(5 + 28*t2 + 24*t2*t2)"
        " - pow(u,7)/5040*(61 + 662*t2 + 1320*t2*t2 + 720*t2*t2*t2)) AS alon FROM g7"
    )
    steps["g9"] = (
        f"SELECT *, {g.AIRY_A!r} / sqrt(1 - {g.AIRY_E2!r} * sin(alat) * sin(alat)) AS an FROM g8"
    )
    steps["g10"] = (
        "SELECT *, an * cos(alat) * cos(alon) AS x, an * cos(alat) * sin(alon) AS y,"
        f" an * (1 - {g.AIRY_E2!r}) * sin(alat) AS z FROM g9"
    )
    k = 1 + g.SHIFT_PPM
    steps["g11"] = (
        f"SELECT *, {g.SHIFT_X!r} + {k!r}*x - {g.ROT_Z!r}*y + {g.ROT_Y!r}*z AS wx,"
        f" {g.SHIFT_Y!r} + {g.ROT_Z!r}*x + {k!r}*y - {g.ROT_X!r}*z AS wy,"
        f" {g.SHIFT_Z!r} - {g.ROT_Y!r}*x + {g.ROT_X!r}*y + {k!r}*z AS wz FROM g10"
    )
    steps["g12"] = (
        "SELECT *, sqrt(wx*wx + wy*wy) AS p,"
        f" atan2(wz, sqrt(wx*wx + wy*wy) * (1 - {g.WGS_E2!r})) AS wl FROM g11"
    )
    for i in range(g.LATITUDE_STEPS):
        steps[f"g{13 + i}"] = (
            f"SELECT * REPLACE (atan2(wz + {g.WGS_E2 * g.WGS_A!r} * sin(wl)"
            f" / sqrt(1 - {g.WGS_E2!r} * sin(wl) * sin(wl)), p) AS wl) FROM g{12 + i}"
        )
    last = f"g{12 + g.LATITUDE_STEPS}"
    steps["placed"] = f"SELECT *, degrees(atan2(wy, wx)) AS lon, degrees(wl) AS lat FROM {last}"
    return steps
