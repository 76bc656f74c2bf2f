"""Longest-match lookup of known projects.

A text yields a short list of names to try, best first. The list is exploded, equi-joined with
the known projects and reduced to the smallest matching position. The join carries no hint: the
catalogue is broadcast when its size is below the session threshold and shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import project_fields


LONGEST = {".": "_longest_dotted", "/": "_longest_slashed"}


def with_longest_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Add the token counts of the longest known project, per separator (0 for no projects).

    Each is a scalar subquery over the catalogue: one number, computed before the rows are read.
    """

    def longest(separator: str) -> Column:
        tokens = known.agg(F.max(F.size(F.split(F.col("name"), "\\" + separator))).alias("tokens"))
        return F.coalesce(tokens.scalar(), F.lit(0))

    return rows.withColumns({column: longest(separator) for separator, column in LONGEST.items()})


def first_known(rows: DataFrame, candidates: Column, known: DataFrame, output: str) -> DataFrame:
    """Add the first candidate that is a known project (null if none) to rows that are all distinct.

    `candidates` may use the columns of `with_longest_known`. Grouping by every column again costs
    no shuffle when the rows already are partitioned by some of their columns, as they are after a
    `distinct` or a `groupBy`. Positions beyond the first that match nothing are dropped before
    grouping, and only the smallest position is aggregated; the name is then read off the list.
    """
    names = known.select(F.col("name").alias("_known"))
    found = F.col("_known").isNotNull()
    tried = (
        with_longest_known(rows, known)
        .select(*rows.columns, F.posexplode_outer(candidates).alias("_position", "_candidate"))
        .join(names, F.col("_candidate") == F.col("_known"), "left")
        .where(found | (F.coalesce(F.col("_position"), F.lit(0)) == 0))
    )
    best = tried.groupBy(*rows.columns).agg(F.min(F.when(found, F.col("_position"))).alias("_best"))
    name = F.when(F.col("_best").isNotNull(), F.get(candidates, F.col("_best")))
    return with_longest_known(best, known).select(*rows.columns, name.alias(output))


def _first_known_of_rows(df: DataFrame, candidates: Column, known: DataFrame, output: str) -> DataFrame:
    """The same for any rows: a number makes them distinct, so they are read once and not joined back."""
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return first_known(numbered, candidates, known, output).select(*df.columns, output)


def match_leading(df: DataFrame, text: str, known: DataFrame, separator: str = ".", output: str = "project") -> DataFrame:
    """Longest run of leading tokens of `text` that is a known project."""
    runs = project_fields.leading_runs(F.col(text), separator, F.col(LONGEST[separator]))
    return _first_known_of_rows(df, runs, known, output)


def match_trailing(df: DataFrame, text: str, known: DataFrame, separator: str = ".", output: str = "project") -> DataFrame:
    """Longest run of trailing tokens of `text` that is a known project."""
    runs = project_fields.trailing_runs(F.col(text), separator, F.col(LONGEST[separator]))
    return _first_known_of_rows(df, runs, known, output)


def _audit_candidates() -> Column:
    listed = project_fields.projects_to_look_up(
        F.col("what"), F.col("access_path"), F.col(LONGEST["."]), F.col(LONGEST["/"])
    )
    return F.when(F.col("_spelled_out").isNull(), listed).otherwise(project_fields.no_names())


def _with_spelled_out(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "_spelled_out", project_fields.spelled_out_project(F.col("what"), F.col("access_path"))
    )


def with_project_of_distinct(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Add `project` to rows that are all distinct, without joining the rows back to themselves."""
    spelled = _with_spelled_out(rows)
    if known is None:
        return spelled.withColumnRenamed("_spelled_out", "project")
    looked_up = first_known(spelled, _audit_candidates(), known, "_looked_up")
    project = F.coalesce(F.col("_spelled_out"), F.col("_looked_up"))
    return looked_up.select(*rows.columns, project.alias("project"))


def with_project(events: DataFrame, known: DataFrame | None) -> DataFrame:
    """Add `project` to any events; equal events keep their number."""
    spelled = _with_spelled_out(events)
    if known is None:
        return spelled.withColumnRenamed("_spelled_out", "project")
    looked_up = _first_known_of_rows(spelled, _audit_candidates(), known, "_looked_up")
    return looked_up.select(*events.columns, F.coalesce("_spelled_out", "_looked_up").alias("project"))
