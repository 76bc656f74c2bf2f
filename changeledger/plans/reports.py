"""Traffic questions answered over the facet counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GIT_COMMANDS = ["git-upload-pack", "git-receive-pack"]


def _git_traffic(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("command").isin(*GIT_COMMANDS))


def _total() -> F.Column:
    return F.sum("num_events").alias("num_events")


def git_traffic_over_time(counts: DataFrame) -> DataFrame:
    """Git events per time bucket."""
    return _git_traffic(counts).groupBy("events_time_bucket").agg(_total())


def git_transport_split(counts: DataFrame) -> DataFrame:
    """Git events over SSH and over HTTP."""
    transport = F.when(F.col("audit_type") == "SSH", "SSH").otherwise("HTTP").alias("transport")
    return _git_traffic(counts).groupBy(transport).agg(_total())


def git_command_split(counts: DataFrame) -> DataFrame:
    """Fetch against push events."""
    return _git_traffic(counts).groupBy("command").agg(_total())


def top_receive_pack_users(counts: DataFrame, limit: int = 10) -> DataFrame:
    """Identified users with the most pushes; ties go to the smaller identifier."""
    pushes = counts.where((F.col("command") == "git-receive-pack") & F.col("user_identifier").isNotNull())
    totals = pushes.groupBy("user_identifier").agg(_total())
    return totals.orderBy(F.desc("num_events"), "user_identifier").limit(limit)
