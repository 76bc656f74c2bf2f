"""Command columns and the facet count of audit events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import audit_fields
from ..schemas import FACETS


def with_command_columns(events: DataFrame) -> DataFrame:
    what, access_path = F.col("what"), F.col("access_path")
    return events.withColumns(
        {
            "command": audit_fields.command(what, access_path, F.col("http_method")),
            "command_arguments": audit_fields.command_arguments(what, access_path),
        }
    )


def with_sub_command(events: DataFrame) -> DataFrame:
    return events.withColumn("sub_command", audit_fields.sub_command(F.col("what"), F.col("access_path")))


def count_facets(events: DataFrame, weight: Column | None = None) -> DataFrame:
    """Number of events per facet combination; `weight` when a row stands for several events."""
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return events.groupBy(*FACETS).agg(counted.alias("num_events"))
