"""Named queries over the test tables, each with the SQL that must give the same rows."""

from .base import CATALOGUE, Query, Tables

from . import (  # noqa: F401  (importing a module registers its queries)
    answers_buildings,
    answers_emissions,
    answers_energy,
    answers_places,
    answers_renewables,
    answers_transport,
    files,
    joined,
    ordering,
    predicates,
    projections,
    reshaping,
    scalars,
    streams,
    totals,
    whole_build,
)

__all__ = ["CATALOGUE", "Query", "Tables"]
