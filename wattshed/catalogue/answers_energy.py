"""Energy and electricity answers over staged worksheet cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import strip_note
from ..plans import energy as en
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import sinks as sk
from ..sources.sheets import header_name, wide_table
from .base import query, rounded
from .inputs import ENERGY_COLUMNS, REGION, REGION_CODES, with_ctes


def _names(t):
    return en.fuel_sector_lookup(t.inputs.fuel_sectors)


def _view(t, which=None):
    return en.energy_view(t.inputs.energy_cells, _names(t), which)


def _sheet_years(t):
    """The years that have a sheet: enough to know the latest one."""
    return t.orders.select(F.year("o_orderdate").alias("calendar_year"))


def electricity_cells(t):
    """The electricity workbook keeps its header one row higher, and without notes."""
    plain = F.regexp_replace("value", r" \[.*", "")
    cells = t.inputs.energy_cells.withColumn("row", F.col("row") - 1)
    at_top = F.col("row") == en.ELECTRICITY_HEADER_ROW
    return cells.withColumn("value", F.when(at_top, plain).otherwise(F.col("value")))


@query(
    "electricity_by_authority", "P01", "SRC-06", "FLT-01", "PRJ-10", "ST-01",
    sql=with_ctes("energy_wide")
    + """SELECT code, calendar_year, count(*) AS n, round(sum(electricity_total), 4) AS electricity
         FROM energy_wide WHERE code LIKE 'E0%' GROUP BY 1, 2""",
)
def _(t):
    wide = en.electricity_by_authority(electricity_cells(t), ["code", "local_authority", "electricity_total"])
    value = F.when(~F.col("electricity_total").startswith("["), F.col("electricity_total"))
    sums = wide.groupBy("code", "calendar_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value.cast("double")).alias("electricity")
    )
    return rounded(sums)


@query(
    "energy_long_by_authority", "P02", "RS-01", "SC-05", "SC-13", "ST-01",
    sql=with_ctes("energy_long")
    + """SELECT country_or_region, local_authority, code, calendar_year, fuel_sector,
                count(*) AS cells, count(ktoe) AS kept, round(sum(ktoe), 4) AS ktoe
         FROM energy_long WHERE code LIKE 'E0%' GROUP BY 1, 2, 3, 4, 5""",
)
def _(t):
    keys = ["country_or_region", "local_authority", "code", "calendar_year", "fuel_sector"]
    sums = en.energy_long(t.inputs.energy_cells).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), F.count("ktoe").alias("kept"), F.sum("ktoe").alias("ktoe")
    )
    return rounded(sums)


@query(
    "fuel_sector_names", "P14", "SC-09", "UDF-01",
    sql=with_ctes("energy_long", "fuel_sectors")
    + """SELECT fuel_sector, fuel, sector, count(*) AS cells
         FROM energy_long JOIN fuel_sectors USING (fuel_sector) GROUP BY 1, 2, 3""",
)
def _(t):
    cells = t.inputs.energy_cells
    heads = cells.where(F.col("row") == 6)
    counted = (
        cells.where(F.col("row") > 6)
        .groupBy("sheet", "col")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(heads.select("sheet", "col", "value"), ["sheet", "col"])
    )
    named = counted.select(strip_note(header_name(F.col("value"))).alias("fuel_sector"), "_n")
    return named.join(_names(t), "fuel_sector").groupBy("fuel_sector", "fuel", "sector").agg(
        F.sum("_n").alias("cells")
    )


@query(
    "energy_by_fuel_and_sector", "P15", "JN-01", "SNK-02",
    sql=with_ctes("energy_view")
    + """SELECT ladnm, calendar_year, fuel, sector, round(sum(ktoe), 4) AS ktoe
         FROM energy_view GROUP BY 1, 2, 3, 4""",
)
def _(t):
    sk.replace_view(_view(t), "wattshed_energy_vw")
    return t.spark.sql(
        """SELECT ladnm, calendar_year, fuel, sector, round(sum(ktoe), 4) AS ktoe
           FROM wattshed_energy_vw GROUP BY ladnm, calendar_year, fuel, sector"""
    )


@query(
    "energy_clean_long", "P25", "SRC-05", "ST-02", "FLT-08", "RS-04", "JN-04", "SNK-05",
    sql=with_ctes("energy_wide", "fuel_sectors")
    + """SELECT calendar_year AS year, ladnm, fuel, sector, count(*) AS n, count(value) AS given,
                round(sum(value), 4) AS value
         FROM (SELECT calendar_year, local_authority AS ladnm, fuel_sector, value
               FROM (SELECT * EXCLUDE (country_or_region, code) FROM energy_wide
                     WHERE local_authority <> 'NATION_7') UNPIVOT INCLUDE NULLS (
                   value FOR fuel_sector IN (all_fuels_domestic,
                       all_fuels_industrial_commercial_and_other, all_fuels_transport,
                       all_fuels_total, electricity_total, gas_total, petroleum_total, coal_total,
                       manufactured_fuels_unlisted)))
         LEFT JOIN fuel_sectors USING (fuel_sector) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    # One authority is named as the rows that are not authorities.
    cells = t.inputs.energy_cells.withColumn(
        "value", F.when(F.col("value") == "NATION_7", "Unallocated").otherwise(F.col("value"))
    )
    long = en.clean_energy_long(cells, _names(t), ENERGY_COLUMNS)
    path = scratch_folder(t.spark, "clean-energy")
    sk.write_parquet(long, path, ["year"])
    stored = t.spark.read.parquet(path)
    sums = stored.groupBy("year", "ladnm", "fuel", "sector").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("given"), F.sum("value").alias("value")
    )
    return rounded(sums)


@query(
    "energy_regional_gwh", "P26", "PRJ-07", "RS-04", "SC-16",
    sql=with_ctes("energy_long", "fuel_sectors")
    + f"""SELECT calendar_year AS year, local_authority, code, named AS fuel_sector, fuel, sector,
                 round(sum(ktoe), 4) AS consumption_ktoe, round(sum(ktoe * 11.63), 2)
                     AS consumption_gwh
          FROM energy_long JOIN (
              SELECT CASE WHEN sector = 'Total' AND fuel <> 'All fuels'
                          THEN lower(fuel) || '_industrial' ELSE fuel_sector END AS named, *
              FROM fuel_sectors) USING (fuel_sector)
          WHERE country_or_region = '{REGION}' AND named NOT LIKE 'all%' AND named NOT LIKE '%total'
          GROUP BY ALL""",
)
def _(t):
    # The sheet's totals of single fuels stand in for what industry uses, so that some rows stay.
    industrial = F.regexp_replace("value", "^(Electricity|Gas|Petroleum|Coal): Total.*", "$1: Industrial")
    cells = t.inputs.energy_cells.withColumn(
        "value", F.when(F.col("row") == 6, industrial).otherwise(F.col("value"))
    )
    names = _names(t)
    names = names.withColumn(
        "fuel_sector",
        F.when(
            (F.col("sector") == "Total") & (F.col("fuel") != "All fuels"),
            F.concat(F.lower("fuel"), F.lit("_industrial")),
        ).otherwise(F.col("fuel_sector")),
    )
    rows = en.regional_energy_gwh(cells, names, REGION)
    keys = ["year", "local_authority", "code", "fuel_sector", "fuel", "sector"]
    sums = rows.groupBy(*keys).agg(
        F.sum("consumption_ktoe").alias("consumption_ktoe"),
        F.sum("consumption_gwh").alias("consumption_gwh"),
    )
    return sums.withColumns(
        {
            "consumption_ktoe": F.round("consumption_ktoe", 4),
            "consumption_gwh": F.round("consumption_gwh", 2),
        }
    )


def _electricity(t):
    return en.energy_long(t.inputs.energy_cells, ["electricity_total"])


# The years of the test tables, which SQL must name; the plan finds them.
_YEARS = list(range(1995, 2002))
_PIVOT = ", ".join(
    f'sum(CASE WHEN calendar_year = {y} THEN ktoe END) AS "{y}"' for y in _YEARS
)
_WEST = "code IN ('E06000003', 'E06000008', 'E06000013', 'E06000018')"


@query(
    "electricity_by_year_wide", "P27", "FLT-04", "RS-05",
    sql=with_ctes("energy_long")
    + "SELECT "
    + ", ".join(f'round("{y}", 4) AS "{y}"' for y in _YEARS)
    + f" FROM (SELECT {_PIVOT} FROM energy_long WHERE fuel_sector = 'electricity_total' AND {_WEST})",
)
def _(t):
    return rounded(en.electricity_by_year_wide(_electricity(t), t.inputs.codes, None, "ktoe"))


for _base, _below in {"old": '"1995"', "new": '"2000"'}.items():

    @query(
        f"electricity_change_on_{_base}", "P27", "SC-17",
        sql=with_ctes("energy_long")
        + f"""SELECT round(("2000" - "1995") * 100 / {_below}, 6) AS change_in_consumption
              FROM (SELECT {_PIVOT} FROM energy_long
                    WHERE fuel_sector = 'electricity_total' AND {_WEST})""",
    )
    def _(t, base=_base):
        wide = en.electricity_by_year_wide(_electricity(t), t.inputs.codes, [1995, 2000], "ktoe")
        return rounded(en.electricity_change(wide, 1995, 2000, base), 6)


_SECTORS = f"""SELECT sector, coalesce(sum(ktoe), 0) AS energy FROM energy_view
    WHERE ladcd IN {REGION_CODES} AND fuel = 'All fuels' AND sector <> 'Total'
      AND calendar_year = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1"""


@query(
    "energy_by_sector_share", "P30", "FLT-11", "FLT-12", "AG-02", "AG-09", "JN-04",
    sql=with_ctes("energy_view", s=_SECTORS)
    + """SELECT sector, round(energy, 4) AS energy_ktoe,
                round(energy / (SELECT sum(energy) FROM s), 6) AS pct_sector,
                round(energy * 11.63, 2) AS energy_gwh,
                CASE sector WHEN 'Domestic' THEN 'home' WHEN 'Transport' THEN 'road' END AS icon
         FROM s""",
)
def _(t):
    named = en.with_sector_icons(
        _latest_sectors(t), {"Domestic": "home", "Transport": "road"}
    )
    return named.withColumns(
        {
            "energy_ktoe": F.round("energy_ktoe", 4),
            "pct_sector": F.round("pct_sector", 6),
            "energy_gwh": F.round("energy_gwh", 2),
        }
    )


def _latest_sectors(t):
    view = _view(t, en.all_fuels_by_sector())
    return en.energy_by_sector(view, t.inputs.authorities, _sheet_years(t))


@query(
    "energy_first_to_last_year", "P31", "AG-03", "AG-05", "WN-01",
    sql=with_ctes(
        "energy_view",
        s=f"""SELECT calendar_year, sum(ktoe * 11.63) AS g FROM energy_view
              WHERE ladcd IN {REGION_CODES} AND fuel = 'All fuels' AND sector = 'Total'
                AND (calendar_year = (SELECT min(year(o_orderdate)) FROM orders)
                     OR calendar_year = (SELECT max(year(o_orderdate)) FROM orders)) GROUP BY 1""",
    )
    + """SELECT calendar_year, round(g, 2) AS total_energy_gwh,
                round(g - lag(g) OVER (ORDER BY calendar_year), 2) AS change,
                round((g - lag(g) OVER (ORDER BY calendar_year)) * 100
                      / lag(g) OVER (ORDER BY calendar_year), 6) AS pct_change FROM s""",
)
def _(t):
    rows = en.energy_change(_view(t, en.all_energy()), t.inputs.authorities, _sheet_years(t))
    return rows.withColumns(
        {
            "total_energy_gwh": F.round("total_energy_gwh", 2),
            "change": F.round("change", 2),
            "pct_change": F.round("pct_change", 6),
        }
    )


@query(
    "energy_by_main_fuel_share", "P32", "SC-19", "AG-02", "AG-09", "SC-14",
    sql=with_ctes(
        "energy_view",
        s=f"""SELECT CASE WHEN fuel IN ('Electricity', 'Gas', 'Petroleum') THEN fuel
                     ELSE 'Other' END AS fuel_type, coalesce(sum(ktoe), 0) AS energy
              FROM energy_view WHERE ladcd IN {REGION_CODES} AND fuel <> 'All fuels'
                AND sector = 'Total'
                AND calendar_year = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1""",
    )
    + """SELECT fuel_type, round(energy, 4) AS energy_ktoe,
                round(energy * 100 / (SELECT sum(energy) FROM s), 6) AS pct_fuel,
                round_even(energy * 100 / (SELECT sum(energy) FROM s), 0) AS percent_fuel FROM s""",
)
def _(t):
    rows = en.energy_by_main_fuel(_view(t, en.totals_by_fuel()), t.inputs.authorities, _sheet_years(t))
    return rows.withColumns(
        {"energy_ktoe": F.round("energy_ktoe", 4), "pct_fuel": F.round("pct_fuel", 6)}
    )


@query(
    "energy_sector_labels", "P33", "SC-14", "SO-03", "WN-02",
    sql=with_ctes(
        "energy_view",
        s=_SECTORS,
        v="""SELECT sector, round_even(energy * 100 / (SELECT sum(energy) FROM s), 0) AS value,
                    CASE sector WHEN 'Industrial commercial and other' THEN 1
                         WHEN 'Transport' THEN 2 WHEN 'Domestic' THEN 3 ELSE 4 END AS place FROM s""",
    )
    + """SELECT sector, value, CAST(place AS BIGINT) AS place,
                sum(value) OVER (ORDER BY place, sector ROWS UNBOUNDED PRECEDING) - 0.5 * value
                    AS y_pos,
                CAST(CAST(value AS INTEGER) AS VARCHAR) || '%' AS label_text FROM v""",
)
def _(t):
    labels = en.sector_label_positions(_latest_sectors(t))
    return labels.withColumn("place", F.col("place").cast("bigint"))


@query(
    "energy_by_authority_ten_years", "P35", "FLT-13", "SC-16",
    sql=with_ctes("energy_view")
    + f"""SELECT calendar_year, ladnm, round(sum(ktoe * 11.63), 2) AS gwh FROM energy_view
          WHERE ladcd IN {REGION_CODES} AND fuel = 'All fuels' AND sector = 'Total'
            AND calendar_year >= (SELECT max(year(o_orderdate)) - 3 FROM orders) GROUP BY 1, 2""",
)
def _(t):
    rows = en.energy_by_authority_recent(
        _view(t, en.all_energy()), t.inputs.authorities, 3, _sheet_years(t)
    )
    return rounded(rows.groupBy("calendar_year", "ladnm").agg(F.sum("gwh").alias("gwh")), 2)


@query(
    "electricity_total_from_extract", "P47", "SRC-10", "AG-01",
    sql=with_ctes("order_sites")
    + """SELECT round(coalesce(sum(o_totalprice * 11.63), 0), 2) AS total_consumption_gwh
         FROM order_sites WHERE ladnm IN ('NATION_3', 'NATION_8') AND yr = 2000
           AND o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def _(t):
    fuel = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Electricity").otherwise(
        "Gas"
    )
    extract = t.inputs.order_sites.select(
        F.col("ladnm").alias("local_authority"),
        F.col("yr").alias("year"),
        fuel.alias("fuel"),
        (F.col("o_totalprice") * 11.63).alias("consumption_gwh"),
    )
    path = scratch_folder(t.spark, "extract")
    sk.write_csv(extract, path)
    landed = de.read_csv(
        t.spark, path, "local_authority string, year int, fuel string, consumption_gwh double"
    )
    return rounded(en.electricity_total(landed, ["NATION_3", "NATION_8"], 2000), 2)


@query(
    "energy_wide_rows", "SRC-06", "PRJ-08", "SC-12",
    sql=with_ctes("energy_wide")
    + """SELECT code, calendar_year, count(electricity_total) AS electricity,
                count(gas_total) AS gas, count(*) AS n FROM energy_wide GROUP BY 1, 2""",
)
def _(t):
    wide = wide_table(
        t.inputs.energy_cells, 6, ["code", "electricity_total", "gas_total"], clean=strip_note
    )
    keyed = wide.groupBy("code", F.col("sheet").cast("int").alias("calendar_year"))
    return keyed.agg(
        F.count(F.col("electricity_total").try_cast("double")).alias("electricity"),
        F.count(F.col("gas_total").try_cast("double")).alias("gas"),
        F.count(F.lit(1)).alias("n"),
    )
