"""Heating descriptions to main-fuel categories by ordered rules.

The rules need the description alone, so they run where the rows are, with no
shuffle; the distinct lookup exists for users who want the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .steps import Get, Step, bound, staged
from .text import ColumnLike, col, plain_words

# The category names of the official statistics.
MAINS_GAS = "Mains gas"
ELECTRICITY = "Electricity"
OIL = "Oil"
COMMUNITY = "Community heating scheme"
RENEWABLE = "Renewable energy(including heat pumps)"
OTHER = "Other and unknown"
TWO_PLAIN = "Two or more(not including renewable energy)"
TWO_RENEWABLE = "Two or more(including renewable energy)"

# The words that show each system, in lower-case plain text.
# Solid fuels, bottled gas and biofuels count as "other" systems.
SYSTEM_WORDS = {
    MAINS_GAS: ["mains gas", "gas central heating", "gas boiler", "natural gas"],
    ELECTRICITY: ["electric", "electricity", "storage heater", "storage heaters"],
    OIL: ["oil"],
    COMMUNITY: ["community", "communal", "district"],
    RENEWABLE: ["heat pump", "heat pumps", "ashp", "gshp", "solar"],
    OTHER: [
        "coal",
        "wood",
        "biomass",
        "lpg",
        "bottled gas",
        "bioethanol",
        "b30k",
        "anthracite",
        "smokeless",
    ],
}

# A heat pump's own electricity is not a second system.
PUMP_POWER = (
    r"heat pumps? (?:(?:radiators|underfloor heating|underfloor|warm air|fan coil units?) )?"
    r"electric(?:ity)?\b"
)


def _shown(name: str):
    """Whether any phrase of a system is among the words."""

    def test(g: Get) -> Column:
        hit = F.lit(False)
        for phrase in SYSTEM_WORDS[name]:
            hit = hit | g("words").contains(f" {phrase} ")
        return hit

    return test


def _rule(g: Get) -> Column:
    many = g("systems") > 1
    chosen = F.when(many & g(RENEWABLE), TWO_RENEWABLE).when(many, TWO_PLAIN)
    for name in (COMMUNITY, RENEWABLE, MAINS_GAS, ELECTRICITY, OIL):
        chosen = chosen.when(g(name), name)
    return chosen.otherwise(OTHER)


def _padded(g: Get) -> Column:
    # Plain words are parted by single spaces, so a padded search finds whole words.
    spaced = F.replace(F.lower(plain_words(g("text"))), F.lit(":"), F.lit(" "))
    return F.coalesce(F.concat(F.lit(" "), spaced, F.lit(" ")), F.lit(""))


def _own_power_left_out(g: Get) -> Column:
    without = F.regexp_replace(g("words"), PUMP_POWER, "heat pump")
    return F.when(g("words").contains("heat pump"), without).otherwise(g("words"))


#: A description (``text``) to its ``category``; the text is cleaned once, each system looked for once.
TO_CATEGORY: list[Step] = [
    {"words": _padded},
    {"words": _own_power_left_out},
    {name: _shown(name) for name in SYSTEM_WORDS},
    {"systems": lambda g: sum((g(name).cast("int") for name in SYSTEM_WORDS), F.lit(0))},
    {"category": _rule},
]


def heating_category(description: ColumnLike) -> Column:
    """One category for each description, as a single column; NULL descriptions count as unknown."""
    return bound({"text": col(description)}, TO_CATEGORY, lambda r: r["category"])


def with_category(df: DataFrame, description: ColumnLike, out: str = "category") -> DataFrame:
    """df with the category of each description, in generated code."""
    return staged(df, {"text": description}, TO_CATEGORY, {out: "category"})


def category_lookup(certificates: DataFrame, description: str = "mainheat") -> DataFrame:
    """Each distinct description once, with its cleaned text and category."""
    distinct = certificates.select(description).where(F.col(description).isNotNull()).distinct()
    return with_category(distinct.withColumn("mainheat_clean", plain_words(description)), description)
