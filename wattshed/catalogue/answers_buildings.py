"""Fuel poverty, certificates and home heating."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import buildings as bu
from ..session import scratch_folder
from ..sources import delimited as de
from ..sources import sinks as sk
from ..sources.sheets import wide_table
from .base import query, rounded
from .inputs import LAST_DAY, stage, with_ctes
from .scalars import category_sql

_CLEAN = r"""trim(regexp_replace(regexp_replace({c}, '[^a-zA-Z0-9\s:]', ' ', 'g'), '\s+', ' ', 'g'))"""
_WORDS = (
    "regexp_replace(lower(" + _CLEAN.format(c="mainheat_description") + "), "
    r"'heat pumps? (?:(?:radiators|underfloor heating|underfloor|warm air|fan coil units?) )?"
    r"electric(?:ity)?\b', 'heat pump', 'g')"
)
_CATEGORY = category_sql("words")
# Every distinct description with its category, then the lodged certificates with theirs.
_HEATING = {
    "looked": f"""SELECT DISTINCT mainheat_description, {_WORDS} AS words FROM certificates
                  WHERE mainheat_description IS NOT NULL
                    AND lodgement_date <= DATE '{LAST_DAY}'""",
    "named": f"SELECT mainheat_description AS mainheat, {_CATEGORY} AS category FROM looked",
    "lodged": f"SELECT * FROM certificates WHERE lodgement_date <= DATE '{LAST_DAY}'",
}


def _poverty_cells(t):
    balance = F.col("c_acctbal")
    cells = {
        "Local authority code": F.col("ladcd"),
        "Nation or region": F.col("cauthnm"),
        "County or Unitary authority": F.when(F.col("c_mktsegment") != "BUILDING", F.col("ladnm")),
        "Local authority district": F.col("c_name"),
        "Number of households": balance + 2000,
        "Number of households in fuel poverty": balance,
        "Proportion of households fuel poor (%)": balance / 100,
    }
    renamed = stage(t.inputs.customers, F.lit("Table 2"), F.col("c_custkey") + 4, 3, cells)
    return renamed.withColumn(
        "value",
        F.when(F.col("row") == 3, F.regexp_replace("value", r" \(%\)", "")).otherwise(F.col("value")),
    )


@query(
    "fuel_poverty_by_authority", "P09", "SRC-06", "FLT-06", "SC-11",
    sql=with_ctes("customers")
    + """SELECT ladcd AS local_authority_code, cauthnm AS nation_or_region,
                ladnm AS county_or_unitary_authority, c_name AS local_authority_district,
                round(c_acctbal + 2000, 2) AS number_of_households,
                round(c_acctbal, 2) AS number_of_households_in_fuel_poverty,
                round(c_acctbal / 100, 4) AS proportion_of_households_fuel_poor
         FROM customers WHERE c_mktsegment <> 'BUILDING'""",
)
def _(t):
    rows = bu.fuel_poverty_by_authority(_poverty_cells(t))
    return rounded(rows)


@query(
    "fuel_poverty_by_small_area", "P09", "SRC-06",
    sql=with_ctes("customers")
    + """SELECT c_name AS local_authority_district, ladnm AS county_or_unitary_authority
         FROM customers WHERE c_mktsegment <> 'BUILDING'
         UNION ALL SELECT c_name, NULL FROM customers WHERE c_mktsegment = 'BUILDING'""",
)
def _(t):
    return bu.fuel_poverty_by_small_area(
        _poverty_cells(t), ["local_authority_district", "county_or_unitary_authority"]
    )


def _lookup_cells(t):
    cells = {
        "LSOA11CD": F.col("c_custkey"),
        "LSOA11NM": F.col("c_name"),
        "CTYUA21CD": F.col("ladcd"),
        "CTYUA21NM": F.col("ladnm"),
    }
    return stage(t.inputs.customers, F.lit("Lookup"), F.col("c_custkey") + 2, 1, cells)


@query(
    "small_area_lookup", "P10", "SRC-06", "PRJ-01",
    sql=with_ctes("customers")
    + """SELECT CAST(c_custkey AS VARCHAR) AS lsoa11cd, c_name AS lsoa11nm, ladcd AS lad_code,
                ladnm AS lad_name FROM customers""",
)
def _(t):
    names = ["lsoa11cd", "lsoa11nm", "ctyua21cd", "ctyua21nm"]
    return bu.small_area_lookup(wide_table(_lookup_cells(t), 1, names))


@query(
    "certificates_by_rating", "P18", "SRC-10", "AG-04",
    sql=with_ctes("certificates")
    + """SELECT local_authority_label AS ladnm, current_energy_rating, construction_epoch,
                count(*) AS "count" FROM certificates GROUP BY 1, 2, 3""",
)
def _(t):
    return bu.certificate_counts(
        t.inputs.certificates.withColumnRenamed("local_authority_label", "ladnm")
    )


@query(
    "heating_descriptions_batched", "P40", "AG-06", "FLT-14", "SC-10", "WN-03", "WN-04",
    sql=with_ctes("certificates", **_HEATING)
    + f"""SELECT mainheat, CAST(id AS BIGINT) AS id, CAST((id - 1) // 100 AS BIGINT) AS batch,
                 CAST(id AS VARCHAR) || '_' || {_CLEAN.format(c='mainheat')} AS mainheat_clean
          FROM (SELECT mainheat, row_number() OVER (ORDER BY mainheat) AS id FROM named)""",
)
def _(t):
    rows = bu.heating_descriptions(t.inputs.certificates, LAST_DAY)
    return rows.withColumn("id", F.col("id").cast("bigint"))


@query(
    "heating_batch_requests", "P40", "WN-04", "AG-13",
    sql=with_ctes("certificates", **_HEATING)
    + f"""SELECT CAST((id - 1) // 100 AS BIGINT) AS batch,
                 string_agg(CAST(id AS VARCHAR) || '_' || {_CLEAN.format(c='mainheat')}, ', '
                            ORDER BY id) AS items
          FROM (SELECT mainheat, row_number() OVER (ORDER BY mainheat) AS id FROM named)
          GROUP BY 1""",
)
def _(t):
    return bu.batch_requests(bu.heating_descriptions(t.inputs.certificates, LAST_DAY))


@query(
    "heating_replies_parsed", "P40", "RS-06",
    sql="""SELECT CAST(p_partkey AS VARCHAR) AS id, replace(p_name, ' ', '_') AS mainheat_chat_out,
                  p_type AS category, count(*) AS n FROM part GROUP BY ALL""",
)
def _(t):
    line = F.concat(
        F.lit("'"), F.col("p_partkey").cast("string"), F.lit("_"),
        F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("'| "), "p_type",
    )
    # One reply for each part: its line, and a blank one.
    replies = t.part.select(F.concat(line, F.lit("\n\n")).alias("reply"))
    parsed = bu.parse_replies(replies)
    return parsed.groupBy("id", "mainheat_chat_out", "category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "heating_categories", "P40", "SC-36", "SRC-16",
    sql=with_ctes("certificates", **_HEATING)
    + f"SELECT mainheat, category, {_CLEAN.format(c='mainheat')} AS mainheat_clean FROM named",
)
def _(t):
    return bu.heating_lookup(t.inputs.certificates, LAST_DAY)


@query(
    "heating_homes", "P34", "JN-02", "FLT-10", "AG-04", "SC-19", "SO-06", "AG-09", "SRC-16",
    sql=with_ctes(
        "certificates",
        **_HEATING,
        c="""SELECT CASE WHEN category LIKE 'Renewable%' THEN 'Renewable (inc. heat pumps)'
                    ELSE category END AS category, count(*) AS n
             FROM certificates JOIN named ON mainheat_description = mainheat
             WHERE category NOT LIKE 'Two%' GROUP BY 1""",
    )
    + "SELECT category, n, round(n / (SELECT sum(n) FROM c), 6) AS pct FROM c ORDER BY n",
)
def _(t):
    path = scratch_folder(t.spark, "heating-lookup")
    sk.write_parquet(bu.heating_lookup(t.inputs.certificates, LAST_DAY), path)
    saved = t.spark.read.parquet(path)
    homes = bu.homes_by_heating(t.inputs.certificates, saved)
    return homes.withColumn("pct", F.round("pct", 6))


@query(
    "heating_by_combined_authority", "JN-05", "P41",
    sql=with_ctes("certificates", **_HEATING)
    + """SELECT cauthnm AS combined_authority, mainheat_description, count(*) AS n_properties
         FROM lodged JOIN ca_la ON local_authority = ladcd GROUP BY 1, 2""",
)
def _(t):
    return bu.heating_counts_by_combined_authority(
        t.inputs.certificates, t.inputs.ca_la.select("ladcd", "cauthnm"), LAST_DAY
    )


_SHARES = {
    "sums": """SELECT local_authority AS local_authority_code, local_authority_label, category,
                      count(*) AS n FROM lodged JOIN named ON mainheat_description = mainheat
               GROUP BY 1, 2, 3""",
    "shares": """SELECT *, n * 100 / sum(n) OVER (PARTITION BY local_authority_code,
                                                  local_authority_label) AS pct FROM sums""",
}

for _saved in (True, False):

    @query(
        "heating_share_by_lookup" if _saved else "heating_share_by_rule",
        "P41", "AG-04", "JN-02", "AG-10", "SC-36",
        sql=with_ctes("certificates", **_HEATING, **_SHARES)
        + """SELECT local_authority_code, local_authority_label, category,
                    CAST(n AS BIGINT) AS n, round(pct, 4) AS pct_domestic_properties FROM shares""",
    )
    def _(t, saved=_saved):
        certificates = t.inputs.certificates
        names = bu.heating_lookup(certificates, LAST_DAY) if saved else None
        if names is not None:
            names = names.select("mainheat", "category")
        return rounded(bu.heating_share_within_authority(certificates, names, LAST_DAY))


# Census fuels stand in as the segments of customers: percent of an authority's.
FUELS = {"AUTOMOBILE": "Mains gas", "BUILDING": "Electricity", "FURNITURE": "Oil",
         "MACHINERY": "Community heating scheme", "HOUSEHOLD": "Other and unknown"}


def _census_cells(t):
    of = lambda seg: F.count_if(F.col("c_mktsegment") == seg) * 100 / F.count(F.lit(1))
    sums = t.inputs.customers.groupBy("cauthnm", "ladcd", "ladnm", "n_nationkey").agg(
        *[of(seg).alias(seg) for seg in FUELS]
    )
    cells = {
        "Region code": F.lit("E12"),
        "Region name": F.col("cauthnm"),
        "Local authority district code": F.col("ladcd"),
        "Local authority district name": F.col("ladnm"),
        **{fuel: F.col(seg) for seg, fuel in FUELS.items()},
        "Renewable energy(including heat pumps)": F.lit("[x]"),
    }
    return stage(sums, F.lit("2a"), F.col("n_nationkey") + 5, 4, cells)


_ALL_FUELS = [*FUELS.values(), "Renewable energy(including heat pumps)"]
_FUEL_CASE = (
    "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FUELS.items()) + " END"
)
_CENSUS = {
    "totals": "SELECT ladcd, ladnm, cauthnm, count(*) AS total FROM customers GROUP BY ALL",
    "fuels": "SELECT * FROM (VALUES "
    + ", ".join(f"('{f}')" for f in _ALL_FUELS)
    + ") AS v(fuel_type)",
    "counts": f"SELECT ladcd, {_FUEL_CASE} AS fuel_type, count(*) AS n FROM customers GROUP BY 1, 2",
    "census": """SELECT cauthnm AS region_name, t.ladcd, ladnm, f.fuel_type,
                        CASE WHEN f.fuel_type NOT LIKE 'Renewable%'
                             THEN coalesce(n, 0) * 100 / total END AS pct
                 FROM totals t CROSS JOIN fuels f
                 LEFT JOIN counts c ON c.ladcd = t.ladcd AND c.fuel_type = f.fuel_type""",
}


@query(
    "heating_census_long", "P39", "SRC-06", "RS-04", "SC-12", "SO-01", "AG-06",
    sql=with_ctes("customers", **_CENSUS)
    + """SELECT 'E12' AS region_code, region_name, ladcd, ladnm, fuel_type,
                round(pct, 4) AS pct_domestic_properties_official FROM census
         ORDER BY region_code, region_name, ladnm, ladcd""",
)
def _(t):
    rows = bu.census_heating_long(_census_cells(t), _ALL_FUELS)
    return rounded(rows).orderBy("region_code", "region_name", "ladnm", "ladcd")


@query(
    "heating_against_census", "P42", "FLT-11", "JN-03", "SC-15",
    sql=with_ctes("certificates", "customers", **_HEATING, **_SHARES, **_CENSUS)
    + """SELECT s.local_authority_code AS ladcd, c.ladnm, s.category AS fuel_type,
                CAST(s.n AS BIGINT) AS n, round(s.pct, 4) AS pct_domestic_properties,
                round(c.pct, 4) AS pct_domestic_properties_official,
                round(s.pct - c.pct, 4) AS diff_pct, round(abs(s.pct - c.pct), 4) AS abs_diff_pct
         FROM shares s JOIN census c ON s.local_authority_code = c.ladcd
              AND s.category = c.fuel_type""",
)
def _(t):
    shares = bu.heating_share_within_authority(t.inputs.certificates, None, LAST_DAY)
    census = bu.census_heating_long(_census_cells(t), _ALL_FUELS)
    return rounded(bu.compare_with_census(shares, census, _ALL_FUELS))


@query(
    "certificates_landed_and_counted", "SRC-10",
    sql=with_ctes("certificates")
    + """SELECT local_authority_label, count(*) AS "count" FROM certificates
         WHERE current_energy_rating = 'A' GROUP BY 1""",
)
def _(t):
    path = scratch_folder(t.spark, "epc")
    sk.write_csv(t.inputs.certificates.select("local_authority_label", "current_energy_rating"), path)
    return de.read_landed_extract(
        t.spark, path, "local_authority_label string, current_energy_rating string",
        {"current_energy_rating": ["A"]}, ["local_authority_label"],
    )
