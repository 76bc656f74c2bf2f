"""Facet counts kept from run to run: each run adds or replaces the counts of one batch of log.

A table is a directory with

* `batches/batch=<name>/day=<yyyymmdd>`: the counts of every batch by itself,
* `counts/day=<yyyymmdd>`: the counts over all batches, which readers read,
* `touched/batch=<name>`: the days that the last run of a batch set out to change.

A run replaces its own batch and recomputes the days that the batch has or had, from the batches of
just these days. So a batch that is run again, after a failure or with a corrected log, counts once,
and late lines of a day come in as part of a later batch. Runs of one table must not overlap.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import FACETS
from .audit import AuditJob, build_audit_counts

#: Day of the events that have no bucket.
NO_DAY = "none"

_COUNTS = "events_time_bucket timestamp, " + ", ".join(f"{name} string" for name in FACETS[1:]) + ", num_events bigint"


def _day() -> Column:
    return F.coalesce(F.date_format("events_time_bucket", "yyyyMMdd"), F.lit(NO_DAY))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The files below a path, or nothing where there are none yet."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _days(frame: DataFrame) -> set[str]:
    """The days of a batch: few, whatever its size."""
    return {row["day"] for row in frame.select("day").distinct().collect()}


def merge_counts(counts: DataFrame, table: str, batch: str) -> list[str]:
    """Make `counts` the counts of `batch`, bring the table up to date, and name the days changed.

    What was planned is written before anything is changed, so a run that failed half-way is completed
    by running it again.
    """
    if re.fullmatch(r"[A-Za-z0-9._-]+", batch) is None:
        raise ValueError(f"a batch is named by letters, digits, dots, dashes and underscores, not '{batch}'")
    spark = counts.sparkSession
    own, plan, merged = f"{table}/batches/batch={batch}", f"{table}/touched/batch={batch}", f"{table}/counts"
    dated = counts.withColumn("day", _day())
    had = _days(_read(spark, own, f"{_COUNTS}, day string")) | _days(_read(spark, plan, "day string"))
    staged = f"{table}/staged/batch={batch}"
    dated.write.mode("overwrite").partitionBy("day").parquet(staged)
    arrived = _read(spark, staged, f"{_COUNTS}, day string")
    touched = sorted(had | _days(arrived))
    spark.createDataFrame([(day,) for day in touched], "day string").coalesce(1).write.mode("overwrite").parquet(plan)
    arrived.write.mode("overwrite").partitionBy("day").parquet(own)

    of_days = _read(spark, f"{table}/batches", f"{_COUNTS}, batch string, day string").where(F.col("day").isin(touched))
    fresh = of_days.groupBy("day", *FACETS).agg(F.sum("num_events").alias("num_events"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(merged)
    # A day that no batch has any more has no rows to overwrite it with.
    for day in sorted(set(touched) - _days(of_days)):
        spark.createDataFrame([], _COUNTS).write.mode("overwrite").parquet(f"{merged}/day={day}")
    return touched


def read_counts(spark: SparkSession, table: str) -> DataFrame:
    """Facet counts over all batches; a condition on `day` reads only the days asked for."""
    return _read(spark, f"{table}/counts", f"{_COUNTS}, day string")


def run_audit_batch(spark: SparkSession, job: AuditJob, batch: str) -> list[str]:
    """The audit job over one batch of log, such as a day's files, merged into the table `job.index`."""
    return merge_counts(build_audit_counts(spark, job), job.index.path, batch)
