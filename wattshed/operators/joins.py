"""Lookup joins and completeness; points in polygons are in areas.py.

Lookups are left to Spark: it broadcasts by measured size, and past its limit
sorts and merges, splitting skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .areas import points_in_polygons, polygon_edges

__all__ = ["lookup", "missing_from", "points_in_polygons", "polygon_edges"]


def lookup(
    facts: DataFrame, table: DataFrame, on: dict[str, str], unmatched: str = "drop"
) -> DataFrame:
    """Join a lookup whose key names may differ; its key columns do not survive.

    ``unmatched``: 'drop' for an inner join, 'keep' for NULLs.
    """
    how = {"drop": "inner", "keep": "left"}[unmatched]
    renamed = table.withColumnsRenamed({right: f"_r_{right}" for right in on.values()})
    same = [facts[left] == renamed[f"_r_{right}"] for left, right in on.items()]
    return facts.join(renamed, same, how).drop(*[f"_r_{right}" for right in on.values()])


def missing_from(expected: DataFrame, received: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that have not been received."""
    return expected.join(received.select(*keys).distinct(), keys, "left_anti")
