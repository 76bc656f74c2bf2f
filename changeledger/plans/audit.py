"""Audit job: log lines -> events -> facet counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit_columns import count_facets, with_command_columns, with_sub_command
from ..operators.audit_events import filter_time_range, with_event_columns, with_time_bucket
from ..operators.broadcasting import broadcast_if_small
from ..operators.known_projects import with_project_of_distinct
from ..operators.users import with_user_columns
from ..session import configure
from ..sinks.documents import Target, write_all
from ..sources.audit_logs import read_audit_log
from ..sources.csv_lists import read_user_types
from ..sources.server_pages import read_accounts, read_known_projects

# The event columns that decide a facet combination, once the start time is bucketed.
COUNTED = ["events_time_bucket", "audit_type", "who", "access_path", "what", "http_method", "result"]


def count_identical(
    events: DataFrame,
    unit: str = "hour",
    since: str | dt.date | None = None,
    until: str | dt.date | None = None,
    whole_last_day: bool = False,
) -> DataFrame:
    """Events within the bounds, counted per bucket and columns that decide a facet."""
    bucketed = filter_time_range(with_event_columns(events), since, until, whole_last_day).transform(with_time_bucket, unit)
    return bucketed.groupBy(*COUNTED).agg(F.count(F.lit(1)).alias("num_events"))


def facets_of_counted(
    counted: DataFrame,
    accounts: DataFrame | None = None,
    user_types: DataFrame | None = None,
    known_projects: DataFrame | None = None,
) -> DataFrame:
    """Facet counts of identical events counted before."""
    enriched = (
        counted.transform(with_project_of_distinct, known_projects)
        .transform(with_user_columns, accounts, user_types)
        .transform(with_command_columns)
        .transform(with_sub_command)
    )
    return count_facets(enriched, weight=F.col("num_events"))


def aggregate_events(
    events: DataFrame,
    accounts: DataFrame | None = None,
    user_types: DataFrame | None = None,
    known_projects: DataFrame | None = None,
    unit: str = "hour",
    since: str | dt.date | None = None,
    until: str | dt.date | None = None,
    whole_last_day: bool = False,
) -> DataFrame:
    """Number of events per facet combination.

    Identical events are counted first and everything else works on the counts. That bounds the
    volume entering the lookups, evaluates the extraction patterns once per distinct text, user and
    bucket, and leaves the counts partitioned by their own columns, which the project lookup
    reuses. A text or user holding a third of the events is folded before the first shuffle.
    """
    counted = count_identical(events, unit, since, until, whole_last_day)
    return facets_of_counted(counted, accounts, user_types, known_projects)


@dataclass(frozen=True)
class AuditJob:
    """Options of the audit job."""

    events_path: str
    index: Target
    known_projects_path: str | None = None
    accounts_path: str | None = None
    additional_user_info_path: str | None = None
    events_time_aggregation: str = "hour"
    since: str | dt.date | None = None
    until: str | dt.date | None = None
    #: Count the whole `until` day, not only its first instant.
    whole_last_day: bool = False


def build_audit_counts(spark: SparkSession, job: AuditJob) -> DataFrame:
    configure(spark)
    known = None
    if job.known_projects_path:
        known = broadcast_if_small(read_known_projects(spark, job.known_projects_path))
    return aggregate_events(
        read_audit_log(spark, job.events_path),
        accounts=read_accounts(spark, job.accounts_path) if job.accounts_path else None,
        user_types=read_user_types(spark, job.additional_user_info_path),
        known_projects=known,
        unit=job.events_time_aggregation,
        since=job.since,
        until=job.until,
        whole_last_day=job.whole_last_day,
    )


def run_audit_job(spark: SparkSession, job: AuditJob) -> None:
    write_all(build_audit_counts(spark, job), [job.index])
