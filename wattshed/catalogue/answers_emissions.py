"""Emissions, carbon intensity and mortality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import only_one
from ..operators.columns import normalise_columns
from ..plans import emissions as em
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import sinks as sk
from .base import query, rounded
from .inputs import REGION_CODES, with_ctes

_POISON = """CASE WHEN count(territorial_emissions_kt_co2e) = count(*)
             THEN sum(territorial_emissions_kt_co2e) END"""
_LATEST = f"""FROM emissions WHERE local_authority_code IN {REGION_CODES}
              AND calendar_year = (SELECT max(calendar_year) FROM emissions)"""


@query(
    "emissions_latest_by_authority", "P36", "AG-03", "FLT-11", "FLT-12",
    sql=with_ctes("emissions")
    + f"SELECT local_authority, round({_POISON}, 2) AS total_emissions {_LATEST} GROUP BY 1",
)
def _(t):
    return rounded(em.latest_emissions_by_authority(t.inputs.emissions, t.inputs.authorities), 2)


@query(
    "emissions_by_year", "P36", "AG-07", "FLT-13",
    sql=with_ctes("emissions")
    + f"""SELECT calendar_year, local_authority, round({_POISON}, 2) AS total_emissions
          FROM emissions WHERE local_authority_code IN {REGION_CODES}
            AND calendar_year >= (SELECT max(calendar_year) - 4 FROM emissions) GROUP BY 1, 2""",
)
def _(t):
    return rounded(em.emissions_by_year(t.inputs.emissions, t.inputs.authorities, 4), 2)


@query(
    "emissions_by_sector", "P36", "AG-09", "AG-03",
    sql=with_ctes(
        "emissions", s=f"SELECT la_ghg_sector, {_POISON} AS x {_LATEST} GROUP BY 1"
    )
    + """SELECT la_ghg_sector, round(x, 2) AS total_emissions,
                round(x / (SELECT sum(x) FROM s), 6) AS pct FROM s""",
)
def _(t):
    rows = em.emissions_by_sector(t.inputs.emissions, t.inputs.authorities)
    return rows.withColumns(
        {"total_emissions": F.round("total_emissions", 2), "pct": F.round("pct", 6)}
    )


def _wide_emissions(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return t.orders.select(
        F.year("o_orderdate").alias("calendar_year"),
        F.when(status == "F", price).alias("industry_total"),
        F.when(status == "O", price).alias("land_use_x_total"),
        (price * 2).alias("transport_total"),
        price.alias("grand_total"),
        price.alias("industry_gas"),
    )


_WIDE_SUMS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS calendar_year,
    coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) AS industry,
    coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 0) AS land,
    coalesce(sum(o_totalprice * 2), 0) AS transport FROM orders GROUP BY 1"""

for _first in (True, False):

    @query(
        "emissions_regional_by_sector" if _first else "emissions_regional_all_underscores",
        "P37", "PRJ-07", "AG-08", "RS-04", "SC-04", "SC-16",
        sql=f"""WITH s AS ({_WIDE_SUMS}), l AS (
                  SELECT calendar_year, 'Industry' AS sector, industry AS x FROM s
                  UNION ALL SELECT calendar_year, '{'Land use_x' if _first else 'Land use x'}', land
                  FROM s
                  UNION ALL SELECT calendar_year, 'Transport', transport FROM s)
                SELECT calendar_year, sector, round(x, 2) AS emissions_ktco2e,
                       round(x / 1000, 5) AS emissions_mtco2e FROM l""",
    )
    def _(t, first=_first):
        rows = em.regional_emissions_long(_wide_emissions(t), first_only=first)
        return rows.withColumns(
            {
                "emissions_ktco2e": F.round("emissions_ktco2e", 2),
                "emissions_mtco2e": F.round("emissions_mtco2e", 5),
            }
        )


for _wanted, _found in ((1999, "1999"), (2050, "(SELECT max(calendar_year) FROM emissions)")):

    @query(
        f"emissions_top_authority_{_wanted}", "P45", "AG-05", "AG-02", "SO-04",
        sql=with_ctes("emissions")
        + f"""SELECT local_authority, round(sum(territorial_emissions_kt_co2e), 2)
                  AS total_emissions FROM emissions WHERE calendar_year = {_found}
              GROUP BY 1 ORDER BY total_emissions DESC LIMIT 1""",
    )
    def _(t, wanted=_wanted):
        return rounded(em.top_emitter(t.inputs.emissions, wanted), 2)


@query(
    "emissions_sector_trend", "P45", "FLT-05", "AG-02",
    sql=with_ctes("emissions")
    + """SELECT calendar_year, round(coalesce(sum(territorial_emissions_kt_co2e), 0), 2)
             AS total_emissions FROM emissions
         WHERE local_authority = 'NATION_8' AND la_ghg_sector = 'Transport'
           AND calendar_year >= 1997 GROUP BY 1 ORDER BY 1""",
)
def _(t):
    return rounded(em.sector_trend(t.inputs.emissions, "NATION_8", "Transport", 1997), 2)


@query(
    "emissions_sector_names", "P45", "AG-06",
    sql=with_ctes("emissions") + "SELECT DISTINCT la_ghg_sector AS sector FROM emissions",
)
def _(t):
    return em.sector_names(t.inputs.emissions)


@query(
    "carbon_intensity_series", "P11", "SRC-02", "PRJ-02",
    sql="""SELECT event_type AS region_name, value AS intensity_gco2kwh, event_id FROM events""",
)
def _(t):
    raw = t.events.select(
        F.col("event_type").alias("Region Name"),
        F.col("value").alias("Intensity (gCO2/kWh)"),
        F.col("event_id").alias("Event ID"),
        F.col("user_id").alias("very_high_upper_limit"),
    )
    path = scratch_folder(t.spark, "intensity")
    sk.write_csv(raw, path)
    schema = (
        "`Region Name` string, `Intensity (gCO2/kWh)` double, `Event ID` bigint, "
        "very_high_upper_limit bigint"
    )
    return em.carbon_bands(normalise_columns(de.read_csv(t.spark, path, schema)))


_VALUES = """SELECT ladcd AS area_code, ladnm AS area_name, CAST(yr AS VARCHAR) AS timeperiod,
                    yr * 10000 AS sortable,
                    CASE WHEN ladnm <> 'NATION_8' THEN count(*) / 10 END AS value
             FROM order_sites GROUP BY ladcd, ladnm, yr"""
_POPULATION = """SELECT ladnm AS local_authority, count(*) AS population FROM customers
                 WHERE ladnm <> 'NATION_13' GROUP BY 1"""


def _mortality(t):
    values = (
        t.inputs.order_sites.groupBy("ladcd", "ladnm", "yr")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("ladcd").alias("area_code"),
            F.col("ladnm").alias("area_name"),
            F.col("yr").cast("string").alias("timeperiod"),
            (F.col("yr") * 10000).alias("timeperiod_sortable"),
            F.when(F.col("ladnm") != "NATION_8", F.col("n") / 10).alias("value"),
        )
    )
    population = (
        t.inputs.customers.where(F.col("ladnm") != "NATION_13")
        .groupBy(F.col("ladnm").alias("local_authority"))
        .agg(F.count(F.lit(1)).alias("population"))
    )
    return values, population


for _rated, _weight in ((False, "population"), (True, "CASE WHEN value IS NOT NULL THEN population END")):

    @query(
        "mortality_weighted_rated" if _rated else "mortality_weighted",
        "P43", "SC-28", "JN-04", "AG-11",
        sql=with_ctes("order_sites", v=_VALUES, p=_POPULATION)
        + f"""SELECT round(sum(value / 100 * population) * 100 / sum({_weight}), 6)
                  AS mortality_fraction FROM v LEFT JOIN p ON area_name = local_authority
              WHERE area_code IN ('E06000003', 'E06000008', 'E06000013', 'E06000018')
                AND timeperiod = (SELECT substr(CAST(max(sortable) AS VARCHAR), 1, 4) FROM v)""",
    )
    def _(t, rated=_rated):
        values, population = _mortality(t)
        return rounded(em.weighted_mortality(values, population, t.inputs.codes, rated), 6)


@query(
    "mortality_indicator_is_single", "P43", "FLT-09", "AG-18",
    sql="""SELECT count(DISTINCT p_type) = 1 AS single FROM part
           WHERE regexp_matches(p_name || ' mortality from air pollution ' || p_type,
                                'mortality.*pollution|pollution.*mortality')
             AND NOT regexp_matches(p_name || p_type, 'old')""",
)
def _(t):
    name = F.concat("p_name", F.lit(" mortality from air pollution "), "p_type")
    indicators = t.part.select(F.col("p_type").alias("indicator_id"), name.alias("indicator_name"))
    return only_one(em.mortality_indicators(indicators), "indicator_id")
