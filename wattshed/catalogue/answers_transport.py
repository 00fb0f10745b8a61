"""Charge points, vehicles, mileage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.columns import normalise_columns
from ..plans import transport as tr
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import sinks as sk
from .base import query, rounded
from .inputs import with_ctes

# Quarter columns of a sheet, in order, for the years the orders move to.
QUARTERS = [
    f"{month}-{year % 100:02d}" for year in range(2020, 2027) for month in ("Jan", "Apr", "Jul", "Oct")
]


def _installs(t):
    """Orders of each customer by quarter, 25 years on."""
    day = F.add_months(F.to_date("o_orderdate"), 300)
    sites = t.inputs.order_sites.withColumn("q", F.date_trunc("quarter", day).cast("date"))
    return sites.groupBy("c_custkey", "ladcd", "ladnm", "q").agg(F.count(F.lit(1)).alias("n"))


def _quarter_cells(t, sheet, code_header, value):
    """One worksheet row for each customer: code, name, and a column for each quarter."""
    installs = _installs(t)
    number = (F.year("q") - 2020) * 4 + F.quarter("q") + 2
    row = (F.col("c_custkey") + 4).alias("row")
    values = installs.select(row, number.cast("int").alias("col"), value.alias("value"))
    ids = t.inputs.customers.select(
        row,
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("col"), F.col("ladcd").alias("value")),
                F.struct(F.lit(2).alias("col"), F.col("ladnm").alias("value")),
            )
        ),
    )
    heads = t.spark.range(1).select(
        F.lit(3).cast("bigint").alias("row"),
        F.posexplode(
            F.array(
                *[F.lit(h) for h in [code_header, "Local authority / region name", *QUARTERS]]
            )
        ),
    ).select("row", (F.col("pos") + 1).alias("col"), F.col("col").alias("value"))
    cells = values.unionByName(ids).unionByName(heads)
    return cells.withColumns({"workbook": F.lit("charging"), "sheet": F.lit(sheet)})


_INSTALLS = """SELECT c_custkey, ladcd, ladnm,
                      CAST(date_trunc('quarter', o_orderdate + INTERVAL 25 YEAR) AS DATE) AS q,
                      count(*) AS n FROM order_sites GROUP BY ALL"""


@query(
    "charge_points_by_quarter", "P05", "SRC-06", "RS-01", "SC-22", "SC-13", "FLT-01", "FLT-06",
    sql=with_ctes("order_sites", i=_INSTALLS)
    + """SELECT ladcd AS la_region_code, ladnm AS la_region_name, q AS quarter,
                count(*) AS areas, CAST(sum(n) AS BIGINT) AS installs
         FROM i WHERE n > 1 AND ladcd LIKE 'E0%' GROUP BY 1, 2, 3""",
)
def _(t):
    value = F.when(F.col("n") > 1, F.col("n").cast("string")).otherwise("[c]")
    cells = _quarter_cells(t, "1a", "Local authority / region code", value)
    rows = tr.charge_points(cells, "1a")
    return rows.groupBy("la_region_code", "la_region_name", "quarter").agg(
        F.count(F.lit(1)).alias("areas"), F.sum("installs").alias("installs")
    )


@query(
    "charge_points_per_head", "P06", "SRC-06", "RS-02", "SC-22", "SC-13",
    sql=with_ctes("order_sites", i=_INSTALLS)
    + """SELECT ladcd AS la_region_code, ladnm AS la_region_name, q AS quarter,
                count(*) AS areas, CAST(sum(floor(n * 12.5 + 0.5)) AS BIGINT) AS cp_100k
         FROM i WHERE ladcd LIKE 'E0%' GROUP BY 1, 2, 3""",
)
def _(t):
    value = (F.col("n") * 12.5).cast("string")
    cells = _quarter_cells(t, "2a", "Local authority / region code \n[Note 5]", value)
    rows = tr.charge_points(cells, "2a", out="cp_100k")
    return rows.groupBy("la_region_code", "la_region_name", "quarter").agg(
        F.count(F.lit(1)).alias("areas"), F.sum("cp_100k").alias("cp_100k")
    )


_VEHICLE_FILE = (
    "`LSOA11CD` string, `LSOA11NM` string, `Fuel` string, `Body-Type` string, "
    "`Keepership` string, `Licence-Status` string, `2025 Q1` string"
)


def _vehicles(t):
    path = scratch_folder(t.spark, "vehicles")
    sk.write_csv(t.inputs.vehicles, path)
    return normalise_columns(de.read_csv_lenient(t.spark, path, _VEHICLE_FILE).drop(de.BAD_RECORD))


def _vehicles_with_bad_rows(t):
    """The same with a rank, which for every tenth customer is not a number: those rows are dropped."""
    path = scratch_folder(t.spark, "spoilt-vehicles")
    rank = F.when(F.substring("LSOA11CD", -1, 1) == "0", "n/a").otherwise("1")
    sk.write_csv(t.inputs.vehicles.withColumn("Rank", rank), path)
    return normalise_columns(de.read_csv_dropping(t.spark, path, _VEHICLE_FILE + ", `Rank` int"))


@query(
    "vehicles_electric", "P08", "SRC-02", "FLT-05", "FLT-07", "PRJ-12",
    sql=with_ctes("vehicles")
    + """SELECT lsoa11cd, lsoa11nm, fuel, CAST(_2025_q1 AS VARCHAR) AS _count FROM vehicles
         WHERE _2025_q1 IS NOT NULL AND (fuel = 'Battery electric' OR fuel LIKE 'Plug%')
           AND lsoa11cd NOT LIKE '%0'""",
)
def _(t):
    return tr.electric_registrations(_vehicles_with_bad_rows(t), "_2025_q1")


for _name, _cols in {
    "vehicles_by_fuel": ["fuel"],
    "vehicles_by_body_and_keeper": ["bodytype", "keepership"],
    "vehicles_by_licence_status": ["bodytype", "keepership", "licencestatus"],
}.items():

    @query(
        _name, "P12", "SRC-04", "PRJ-16", "FLT-02", "SC-11",
        sql=with_ctes("vehicles")
        + f"""SELECT lsoa11cd, lsoa11nm, {', '.join(_cols)},
                     CAST(round(_2025_q1) AS INTEGER) AS _2025_q1 FROM vehicles
              WHERE _2025_q1 IS NOT NULL AND substr(lsoa11cd, 1, 1) = 'E'
                AND {' AND '.join(f"{c} <> 'Total'" for c in _cols)}""",
    )
    def _(t, cols=_cols):
        return tr.latest_vehicles(_vehicles(t), "_2025_q1", cols)


def mileage_cells(t):
    """One worksheet row for each customer: ids, notes and a column for each year."""
    sums = t.inputs.order_sites.groupBy("c_custkey", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("miles")
    )
    row = (F.col("c_custkey") + 6).alias("row")
    value = F.when(F.col("n") > 1, F.col("miles").cast("string")).otherwise("[x]")
    values = sums.select(row, (F.col("yr") - 1995 + 5).alias("col"), value.alias("value"))
    ids = t.inputs.customers.select(
        row,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i + 1).alias("col"), v.alias("value"))
                    for i, v in enumerate(
                        [F.col("ladcd"), F.col("ladnm"), F.lit("a note"), F.lit("million miles")]
                    )
                ]
            )
        ),
    )
    names = ["Local Authority or Region Code", "Local Authority or Region", "Notes", "Units"]
    heads = t.spark.range(1).select(
        F.lit(5).cast("bigint").alias("row"),
        F.posexplode(F.array(*[F.lit(h) for h in [*names, *map(str, range(1995, 2002))]])),
    ).select("row", (F.col("pos") + 1).alias("col"), F.col("col").alias("value"))
    return values.unionByName(ids).unionByName(heads).withColumns(
        {"workbook": F.lit("miles"), "sheet": F.lit("TRA8901")}
    )


@query(
    "vehicle_mileage_by_year", "P13", "SRC-06", "RS-02", "PRJ-03", "SC-01", "SC-13",
    sql=with_ctes(
        "order_sites",
        m="""SELECT c_custkey, ladcd, ladnm, yr, count(*) AS n, sum(o_totalprice) AS miles
             FROM order_sites GROUP BY ALL""",
    )
    + """SELECT ladcd AS local_authority_or_region_code, ladnm AS local_authority_or_region,
                yr AS year, count(*) AS n, count(CASE WHEN n > 1 THEN 1 END) AS given,
                round(sum(CASE WHEN n > 1 THEN miles END), 2) AS mileage_millions
         FROM m WHERE ladcd LIKE 'E0%' GROUP BY 1, 2, 3""",
)
def _(t):
    rows = tr.vehicle_mileage(mileage_cells(t))
    keys = ["local_authority_or_region_code", "local_authority_or_region", "year"]
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("mileage_millions").alias("given"),
        F.sum("mileage_millions").alias("mileage_millions"),
    )
    return rounded(out, 2)
