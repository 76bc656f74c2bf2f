"""Contributor lines landed per project and ref under `<root>/project=<name>/ref=<ref>/`.

In the directory, the characters of ESCAPED in names and refs are percent-encoded, others stand for
themselves: that is what partition discovery decodes (it does not know encoded UTF-8). Without a ref, which means the project's default branch, the directory is
`ref=__HIVE_DEFAULT_PARTITION__`, as Spark itself names the one of null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_not_blank
from ..operators.broadcasting import broadcast_if_small


DEFAULT_REF = "__HIVE_DEFAULT_PARTITION__"
# The percent sign comes first, so that it is not encoded twice.
ESCAPED = "%\"#'*/:=?\\{}[]^ +"


def partition_directory(value: Column) -> Column:
    """A partition value as it is written in a directory's name."""
    for character in ESCAPED:
        value = F.replace(value, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return value


def landing_location(root: str | None) -> Callable[[Column, Column, Column], Column]:
    """Where a project's lines are landed, as a function of its id, name and ref.

    Without a root there is no location.
    """

    def location(project_id: Column, name: Column, ref_name: Column) -> Column:
        ref = F.coalesce(partition_directory(F.nullif(ref_name, F.lit(""))), F.lit(DEFAULT_REF))
        return F.concat(F.lit(root).cast("string"), F.lit("/project="), partition_directory(name), F.lit("/ref="), ref)

    return location


def with_source(projects: DataFrame, location: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """(`project`, `ref`, `source`) of each project; `source` may be null, a null `ref` is the default branch."""
    source = location(F.col("id"), F.col("name"), F.col("ref_name"))
    ref = F.nullif(F.col("ref_name"), F.lit(""))
    return projects.select(F.col("name").alias("project"), ref.alias("ref"), source.alias("source"))


def drop_blank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(is_not_blank(F.col(column)))


def read_contributor_lines(spark: SparkSession, root: str, project_sources: DataFrame) -> DataFrame:
    """(`project`, `ref`, `json`) lines of the projects that have a source, each from its own ref.

    The landing root is read and joined with the projects, rather than listing one path per
    project: a project that was never landed simply gives no rows, and the join on the partition
    columns lets Spark skip the directories of other projects (dynamic partition pruning, which
    Spark only tries when the small side has an ordering comparison, hence the test for a name). The explicit schema keeps numeric-looking names as text.
    """
    landed = spark.read.schema("value string, project string, ref string").text(root)
    named = F.col("source").isNotNull() & (F.col("project") > "")
    wanted = project_sources.where(named).select(
        F.col("project").alias("_project"), F.coalesce(F.nullif(F.col("ref"), F.lit("")), F.lit("")).alias("_ref")
    )
    same = (F.col("project") == F.col("_project")) & (F.coalesce(F.col("ref"), F.lit("")) == F.col("_ref"))
    lines = drop_blank_lines(landed).join(broadcast_if_small(wanted.distinct()), same)
    return lines.select("project", F.nullif(F.col("ref"), F.lit("")).alias("ref"), F.col("value").alias("json"))
