"""Contributor-activity lines: flattening, organisation, aliases, tags, commit ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.organization import organization_of
from ..schemas import CONTRIBUTOR_FIELDS
from .parsed_json import inline_json

_RENAMED = {"name": "author"}


def flatten_contributors(lines: DataFrame, with_commits: bool = True) -> DataFrame:
    """(`project`, `json`) lines to one row per line with 19 flat columns.

    A line that is not JSON keeps its project and has nulls elsewhere. Where the lines have a `ref`,
    it is the starting revision of those that state none. `with_commits=False` leaves the commit list
    out of the parse for plans that drop it anyway.
    """
    fields = {k: v for k, v in CONTRIBUTOR_FIELDS.items() if with_commits or k != "commits"}
    schema = ", ".join(f"{name} {data_type}" for name, data_type in fields.items())
    has_ref = "ref" in lines.columns
    parsed = inline_json(lines, "json", schema, keep=["project", "ref"] if has_ref else ["project"])
    if has_ref:
        parsed = parsed.withColumn("starting_revision", F.coalesce("starting_revision", "ref"))
    return parsed.select("project", *[F.col(name).alias(_RENAMED.get(name, name)) for name in fields])


def with_organization(df: DataFrame) -> DataFrame:
    return df.withColumn("organization", organization_of(F.col("email")))


def alias_overrides() -> dict[str, Column]:
    """Author and organisation where `_alias_author`, `_alias_organization` override them."""
    organization = F.when(
        F.col("_alias_organization") != "", F.lower(F.col("_alias_organization"))
    ).otherwise(F.col("organization"))
    return {
        "author": F.coalesce(F.col("_alias_author"), F.col("author")).alias("author"),
        "organization": organization.alias("organization"),
    }


def apply_aliases(df: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Override author and organisation of the emails that have an alias.

    Emails compare exactly. An alias organisation that is empty or null keeps the existing one, any
    other is lower-cased; a null alias author keeps the existing one. Several aliases of one email
    give several rows. The join carries no hint, see known_projects.
    """
    if aliases is None:
        return df
    renamed = aliases.select(
        F.col("email").alias("_alias_email"),
        F.col("author").alias("_alias_author"),
        F.col("organization").alias("_alias_organization"),
    )
    overridden = alias_overrides()
    return df.join(renamed, F.col("email") == F.col("_alias_email"), "left").select(
        *[overridden.get(c, F.col(c)) for c in df.columns]
    )


def drop_commits(df: DataFrame) -> DataFrame:
    return df.drop("commits")


def with_manifest_tags(df: DataFrame, label: str, branch: str | None = None) -> DataFrame:
    tagged = df.withColumn("manifest_label", F.lit(label))
    return tagged if branch is None else tagged.withColumn("manifest_branch", F.lit(branch))


def commit_ids(df: DataFrame) -> DataFrame:
    """Distinct commit ids over all projects."""
    return df.select(F.explode("commits.sha1").alias("sha1")).distinct()


def filter_name_prefix(projects: DataFrame, prefix: str | None = None) -> DataFrame:
    """Projects whose name starts with the prefix, case-sensitively."""
    return projects if prefix is None else projects.where(F.col("name").startswith(prefix))
