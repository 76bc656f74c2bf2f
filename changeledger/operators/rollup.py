"""Contributor rollup of raw commit changes, at five grains."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..schemas import CONTRIBUTOR_FIELDS
from ..session import require_utc

# Aggregation name -> time parts kept beside project, author and email.
GRAINS = {
    "email": [],
    "email_year": ["year"],
    "email_month": ["year", "month"],
    "email_day": ["year", "month", "day"],
    "email_hour": ["year", "month", "day", "hour"],
}
_TIME_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}


def filter_commit_dates(
    changes: DataFrame, since: str | dt.date | None = None, until: str | dt.date | None = None
) -> DataFrame:
    """Changes of commits within the bounds, both start-of-day and inclusive."""
    if since is None and until is None:
        return changes
    return changes.where(times.within_range(F.col("date"), since, until))


def _with_branches(rolled: DataFrame, keyed: DataFrame, grain: list[str]) -> DataFrame:
    """Add the sorted branch names of each group.

    Sets of branches are made distinct before their names are gathered, so what is gathered grows with
    a project's branches and not with its commits. Gathering beside the counters would turn their hash
    aggregation into a sorting one. Both sides end up grouped by the grain and are small by then.
    """
    named = keyed.select(*grain, F.array_sort(F.array_compact("branches")).alias("_set")).distinct()
    each = named.select(*[F.col(name).alias(f"_{name}") for name in grain], F.explode("_set").alias("_branch")).distinct()
    branches = each.groupBy(*[f"_{name}" for name in grain]).agg(F.sort_array(F.collect_list("_branch")).alias("branches"))
    same = F.lit(True)
    for name in grain:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return rolled.join(branches, same, "left").drop(*[f"_{name}" for name in grain])


def roll_up_contributors(changes: DataFrame, aggregate: str = "email", extract_branches: bool = False) -> DataFrame:
    """Activity per project, author, email and time grain, in the flattened contributor layout.

    `changes` has one row per file touched by a commit: project, author, email, sha1, date (epoch
    ms), merge, file, added_lines, deleted_lines and, for `extract_branches`, branches: a commit on
    several branches has one row per file all the same, so it is measured once. Distinct
    commits and files are counted exactly by two-phase aggregation, so a contributor holding most
    of the rows is spread over tasks by commit and file; no commit list is gathered per group (the
    `commits` column is null, commit ids come as rows from the changes themselves).
    Counters are bigint: a busy contributor's total may exceed the int of a parsed line.
    """
    if aggregate not in GRAINS:
        raise ValueError(f"unknown aggregation '{aggregate}', expected one of {', '.join(GRAINS)}")
    require_utc(changes)
    parts = GRAINS[aggregate]
    committed = times.epoch_ms_to_timestamp(F.col("date"))
    keyed = changes.withColumns({name: _TIME_PARTS[name](committed) for name in parts}) if parts else changes
    measures = [
        F.count("file").alias("num_files"),
        F.count_distinct("file").alias("num_distinct_files"),
        F.sum("added_lines").alias("added_lines"),
        F.sum("deleted_lines").alias("deleted_lines"),
        F.count_distinct("sha1").alias("num_commits"),
        F.max("date").alias("last_commit_date"),
        F.bool_or("merge").alias("is_merge"),
    ]
    grain = ["project", "author", "email", *parts]
    rolled = keyed.groupBy(*grain).agg(*measures)
    if extract_branches:
        rolled = _with_branches(rolled, keyed, grain)
    present = set(rolled.columns)
    layout = {("author" if name == "name" else name): t for name, t in CONTRIBUTOR_FIELDS.items()}
    return rolled.select(
        "project",
        *[F.col(n) if n in present else F.lit(None).cast(t).alias(n) for n, t in layout.items()],
    )
