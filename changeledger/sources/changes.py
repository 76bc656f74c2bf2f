"""Raw commit changes: a row per file touched by a commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.broadcasting import broadcast_if_small
from ..schemas import COMMIT_CHANGE


def read_commit_changes(spark: SparkSession, path: str | list[str], projects: DataFrame) -> DataFrame:
    """Parquet changes of the given projects; date bounds applied later reach the scan."""
    changes = spark.read.schema(COMMIT_CHANGE).parquet(*([path] if isinstance(path, str) else path))
    wanted = projects.where(F.col("name") > "").select(F.col("name").alias("project")).distinct()
    return changes.join(broadcast_if_small(wanted), "project", "left_semi")
