"""Commits job: contributor activity -> organisation, aliases, tags -> documents.

The activity is either landed per project as contributor lines, or computed from raw commit changes.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.broadcasting import broadcast_if_small
from ..operators.contributors import (
    apply_aliases,
    drop_commits,
    filter_name_prefix,
    flatten_contributors,
    with_manifest_tags,
    with_organization,
)
from ..operators.rollup import filter_commit_dates, roll_up_contributors
from ..schemas import PROJECT
from ..session import configure
from ..sinks.documents import Target, write_all
from ..sources.changes import read_commit_changes
from ..sources.contributors import landing_location, read_contributor_lines, with_source
from ..sources.csv_lists import read_aliases
from ..sources.manifest import read_manifest
from ..sources.server_pages import read_project_listing


@dataclass(frozen=True)
class CommitsJob:
    """Options of the commits job.

    `aggregate`, `since`, `until` and `extract_branches` shape the activity computed from
    `changes_path`; landed lines were shaped when they were landed.
    """

    landing_root: str | None = None
    changes_path: str | None = None
    aggregate: str | None = None
    since: str | dt.date | None = None
    until: str | dt.date | None = None
    extract_branches: bool = False
    listing_path: str | None = None
    prefix: str | None = None
    manifest: str | None = None
    manifest_branch: str | None = None
    manifest_label: str | None = None
    email_aliases: str | None = None
    output_dir: str | None = None
    index: Target | None = None

    def __post_init__(self) -> None:
        shaping = (self.aggregate, self.since, self.until, self.extract_branches or None)
        if self.changes_path is None and any(option is not None for option in shaping):
            raise ValueError("aggregate, since, until and extract_branches need changes_path")


def contributor_stats(spark: SparkSession, projects: DataFrame, root: str | None, with_commits: bool = True) -> DataFrame:
    """Flat contributor rows of the projects landed under the root."""
    if root is None:
        lines = spark.createDataFrame([], "project string, ref string, json string")
    else:
        lines = read_contributor_lines(spark, root, with_source(projects, landing_location(root)))
    return flatten_contributors(lines, with_commits)


def contributor_stats_of_changes(
    changes: DataFrame,
    aggregate: str = "email",
    since: str | dt.date | None = None,
    until: str | dt.date | None = None,
    extract_branches: bool = False,
) -> DataFrame:
    """The same rows, computed from raw commit changes."""
    return roll_up_contributors(filter_commit_dates(changes, since, until), aggregate, extract_branches)


def dashboard_stats(stats: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Organisation from the email first, so that an alias can override it; no commit lists."""
    return stats.transform(with_organization).transform(apply_aliases, aliases).transform(drop_commits)


def select_projects(spark: SparkSession, job: CommitsJob) -> DataFrame:
    """Projects of the manifest, else of the listing (by prefix), else none."""
    if job.manifest is not None:
        return read_manifest(spark, job.manifest)
    if job.listing_path is not None:
        return filter_name_prefix(read_project_listing(spark, job.listing_path), job.prefix)
    return spark.createDataFrame([], PROJECT)


def project_stats(stats: DataFrame, job: CommitsJob, aliases: DataFrame | None) -> DataFrame:
    """Dashboard rows, tagged when both a manifest and a label are configured."""
    rows = dashboard_stats(stats, aliases)
    if job.manifest is not None and job.manifest_label is not None:
        rows = with_manifest_tags(rows, job.manifest_label, job.manifest_branch)
    return rows


def build_project_stats(spark: SparkSession, job: CommitsJob) -> DataFrame:
    configure(spark)
    projects = select_projects(spark, job)
    if job.changes_path is not None:
        changes = read_commit_changes(spark, job.changes_path, projects)
        stats = contributor_stats_of_changes(
            changes, job.aggregate or "email", job.since, job.until, job.extract_branches
        )
    else:
        stats = contributor_stats(spark, projects, job.landing_root, with_commits=False)
    aliases = read_aliases(spark, job.email_aliases)
    return project_stats(stats, job, None if aliases is None else broadcast_if_small(aliases))


def run_commits_job(spark: SparkSession, job: CommitsJob, count: bool = False) -> int | None:
    """Write the documents, then the index, as configured; optionally count the rows."""
    documents = None if job.output_dir is None else Target(job.output_dir)
    if documents is None and job.index is None:
        raise ValueError("the commits job needs an output_dir or an index")
    return write_all(build_project_stats(spark, job), [documents, job.index], count)
