"""Fuel poverty, energy certificates and home heating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.heating import category_lookup, with_category
from ..functions.numbers import absolute_gap, lenient_cast
from ..functions.text import plain_words
from ..operators.aggregates import share_of_total, share_within
from ..operators.filters import members_of
from ..operators.joins import lookup
from ..operators.ordered import batches
from ..operators.reshape import lines, split_in_two, to_long
from ..sources.sheets import wide_table

# Columns of the two fuel-poverty tables and of the census table.
POVERTY_AUTHORITY_COLUMNS = [
    "local_authority_code",
    "nation_or_region",
    "county_or_unitary_authority",
    "local_authority_district",
    "number_of_households",
    "number_of_households_in_fuel_poverty",
    "proportion_of_households_fuel_poor",
]
POVERTY_HEADER_ROW = 3
CENSUS_HEADER_ROW = 4
CENSUS_IDS = [
    "Region code",
    "Region name",
    "Local authority district code",
    "Local authority district name",
]
RENEWABLE_LABEL = "Renewable (inc. heat pumps)"


def fuel_poverty_by_authority(cells: DataFrame) -> DataFrame:
    """Rows with an authority name, the three measures as numbers."""
    wide = wide_table(cells, POVERTY_HEADER_ROW, POVERTY_AUTHORITY_COLUMNS, blank_rows=False)
    measures = POVERTY_AUTHORITY_COLUMNS[4:]
    return wide.where(F.col("county_or_unitary_authority").isNotNull()).select(
        *POVERTY_AUTHORITY_COLUMNS[:4], *[F.col(c).cast("double").alias(c) for c in measures]
    )


def fuel_poverty_by_small_area(cells: DataFrame, columns: list[str]) -> DataFrame:
    return wide_table(cells, POVERTY_HEADER_ROW, columns).select(*columns)


def small_area_lookup(raw: DataFrame) -> DataFrame:
    """Small area to upper-tier authority."""
    return raw.select(
        "lsoa11cd",
        "lsoa11nm",
        F.col("ctyua21cd").alias("lad_code"),
        F.col("ctyua21nm").alias("lad_name"),
    )


def certificate_counts(certificates: DataFrame) -> DataFrame:
    """Certificates by authority, rating and construction period."""
    return certificates.groupBy("ladnm", "current_energy_rating", "construction_epoch").agg(
        F.count(F.lit(1)).alias("count")
    )


def _lodged_by(certificates: DataFrame, last_day: str) -> DataFrame:
    return certificates.where(F.col("lodgement_date") <= F.lit(last_day).cast("date"))


def heating_descriptions(certificates: DataFrame, last_day: str) -> DataFrame:
    """Distinct descriptions, numbered, cleaned and prefixed with the number, in batches of 100."""
    kept = _lodged_by(certificates, last_day).where(F.col("mainheat_description").isNotNull())
    distinct = kept.select(F.col("mainheat_description").alias("mainheat")).distinct()
    numbered = batches(distinct, ["mainheat"], 100)
    prefixed = F.concat(F.col("id").cast("string"), F.lit("_"), plain_words("mainheat"))
    return numbered.withColumn("mainheat_clean", prefixed)


def batch_requests(descriptions: DataFrame) -> DataFrame:
    """One text for each batch of 100, in order."""
    items = F.array_sort(F.collect_list(F.struct("id", "mainheat_clean")))
    return descriptions.groupBy("batch").agg(
        F.concat_ws(", ", F.transform(items, lambda i: i["mainheat_clean"])).alias("items")
    )


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Lines ``id_text| category`` to (id, mainheat_chat_out, category), quotes removed."""
    rows = replies.select(lines(reply).alias("_line"))
    rows = split_in_two(rows, "_line", "| ", "_item", "category")
    rows = rows.withColumn("_item", F.regexp_replace("_item", "'", ""))
    rows = split_in_two(rows, "_item", "_", "id", "mainheat_chat_out")
    return rows.select("id", "mainheat_chat_out", "category")


def heating_lookup(certificates: DataFrame, last_day: str) -> DataFrame:
    """Each description with its category."""
    kept = _lodged_by(certificates, last_day)
    return category_lookup(kept.withColumnRenamed("mainheat_description", "mainheat"))


def homes_by_heating(certificates: DataFrame, categories: DataFrame) -> DataFrame:
    """Homes by category with share, multi-system homes left out; ordered by count at the end."""
    by_text = certificates.groupBy("mainheat_description").agg(F.count(F.lit(1)).alias("_n"))
    joined = lookup(by_text, categories, {"mainheat_description": "mainheat"}).where(
        ~F.col("category").startswith("Two")
    )
    shown = F.when(F.col("category").startswith("Renewable"), RENEWABLE_LABEL).otherwise(
        F.col("category")
    )
    counts = joined.groupBy(shown.alias("category")).agg(F.sum("_n").alias("n"))
    return share_of_total(counts, "n", "pct").orderBy("n")


def heating_counts_by_combined_authority(
    certificates: DataFrame, ca_la: DataFrame, last_day: str
) -> DataFrame:
    """Certificates by combined authority and description."""
    counted = (
        _lodged_by(certificates, last_day)
        .groupBy("local_authority", "mainheat_description")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    joined = lookup(counted, ca_la, {"local_authority": "ladcd"})
    return joined.groupBy(
        F.col("cauthnm").alias("combined_authority"), "mainheat_description"
    ).agg(F.sum("_n").alias("n_properties"))


def heating_share_within_authority(
    certificates: DataFrame, categories: DataFrame | None, last_day: str
) -> DataFrame:
    """Each category's percent of its authority's certificates.

    Certificates are counted before they meet the lookup. Without a lookup the
    rules classify the counted descriptions directly.
    """
    counted = (
        _lodged_by(certificates, last_day)
        .groupBy("local_authority", "local_authority_label", "mainheat_description")
        .agg(F.count(F.lit(1)).alias("n_properties"))
    )
    if categories is None:
        named = with_category(counted.where(F.col("mainheat_description").isNotNull()), "mainheat_description")
    else:
        named = lookup(counted, categories, {"mainheat_description": "mainheat"})
    sums = named.groupBy(
        F.col("local_authority").alias("local_authority_code"),
        F.col("local_authority_label"),
        "category",
    ).agg(F.sum("n_properties").alias("n"))
    return share_within(
        sums, "n", ["local_authority_code", "local_authority_label"], "pct_domestic_properties"
    )


def census_heating_long(cells: DataFrame, fuels: list[str]) -> DataFrame:
    """Census shares of each main fuel by authority, missing cells kept."""
    wide = wide_table(cells, CENSUS_HEADER_ROW, [*CENSUS_IDS, *fuels], style="as_is")
    rows = wide.select(
        F.col("Region code").alias("region_code"),
        F.col("Region name").alias("region_name"),
        F.col("Local authority district code").alias("ladcd"),
        F.col("Local authority district name").alias("ladnm"),
        *[lenient_cast(F.col(f"`{c}`")).alias(c) for c in fuels],
    )
    ids = ["region_code", "region_name", "ladcd", "ladnm"]
    return to_long(rows, ids, "fuel_type", "pct_domestic_properties_official", keep_nulls=True)


def compare_with_census(shares: DataFrame, census: DataFrame, fuels: list[str]) -> DataFrame:
    """Certificate shares against census shares, where both have the authority and fuel."""
    official = members_of(
        census.where(F.col("fuel_type").isin(fuels)), "ladcd", shares, "local_authority_code"
    ).select("ladcd", "ladnm", "fuel_type", "pct_domestic_properties_official")
    ours = shares.select(
        F.col("local_authority_code").alias("ladcd"),
        F.col("category").alias("fuel_type"),
        "n",
        "pct_domestic_properties",
    )
    gap = F.col("pct_domestic_properties") - F.col("pct_domestic_properties_official")
    return ours.join(official, ["ladcd", "fuel_type"]).withColumns(
        {
            "diff_pct": gap,
            "abs_diff_pct": absolute_gap(
                "pct_domestic_properties", "pct_domestic_properties_official"
            ),
        }
    )
