"""Totals of facet counts over several groupings at once."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FACETS

CUBE_FACETS = ["audit_type", "user_type", "command", "events_time_bucket"]


def all_sets(facets: list[str]) -> list[list[str]]:
    """Every choice of the facets, the whole one first and the grand total last."""
    return [list(chosen) for size in range(len(facets), -1, -1) for chosen in combinations(facets, size)]


def facet_cube(counts: DataFrame, facets: list[str] | None = None, sets: list[list[str]] | None = None) -> DataFrame:
    """`num_events` per combination of the facets, for each of the `sets` of facets kept.

    A facet that a set leaves out is null; `grouping_id` tells it from a facet that has no value: it
    has a bit per facet, the first one highest, set where the facet is left out. Counts are folded to
    the finest grouping first, so only the folded rows are multiplied by the number of sets, and one
    shuffle serves them all.
    """
    facets = CUBE_FACETS if facets is None else facets
    unknown = set(facets) - set(FACETS)
    if unknown:
        raise ValueError(f"unknown facets {', '.join(sorted(unknown))}, expected some of {', '.join(FACETS)}")
    wanted = all_sets(facets) if sets is None else sets
    folded = counts.groupBy(*facets).agg(F.sum("num_events").alias("num_events"))
    columns = [[F.col(name) for name in chosen] for chosen in wanted]
    cube = folded.groupingSets(columns, *[F.col(name) for name in facets])
    return cube.agg(F.grouping_id().alias("grouping_id"), F.sum("num_events").alias("num_events"))
