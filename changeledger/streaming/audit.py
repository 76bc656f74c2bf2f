"""Audit job on live logs: facet counts of time buckets that are complete.

Lines are read as a stream. Identical events are counted in state, per time bucket; a bucket is closed
when an event at least `delay` later has been seen, and only then its counts leave the state, all in
one batch. Lookups and the facet count then run on that batch with the operators of the batch job, so
a stream ends with the rows of the job over the same log.

* State holds one row per distinct event of the open buckets, whatever the number of lines.
* The watermark lies on the bucket itself. A line that comes after its bucket was closed is late: it is
  dropped and counted in the query's progress (`numRowsDroppedByWatermark`). Allow at least one bucket.
* Events without a bucket (times outside the years 1 to 9999) are left out: no time would close it.
* Each closed bucket is a directory of the output, written by one batch. A batch that is repeated after
  a failure overwrites just its own buckets, so a restart from the checkpoint counts nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit_events import filter_time_range, parse_audit_lines, with_time_bucket
from ..operators.broadcasting import broadcast_if_small
from ..plans.audit import COUNTED, AuditJob, facets_of_counted
from ..schemas import FACETS
from ..session import configure
from ..sources.csv_lists import read_user_types
from ..sources.server_pages import read_accounts, read_known_projects

#: Directory of a bucket; times as they are written have characters that directories escape.
_BUCKET_DIRECTORY = "bucket"


@dataclass(frozen=True)
class AuditStream:
    """Options of the live audit job: those of the batch job, and how a stream is kept.

    `job.events_path` is a directory that lines are added to as whole files; `job.index` is a
    directory of files. `max_files` bounds a batch.
    """

    job: AuditJob
    checkpoint: str
    delay: str = "1 hour"
    max_files: int | None = None


def read_audit_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the files that a directory holds and will hold."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def count_closed_buckets(lines: DataFrame, stream: AuditStream) -> DataFrame:
    """Streaming counts of identical events; a bucket's rows come when it is closed."""
    events = filter_time_range(parse_audit_lines(lines), stream.job.since, stream.job.until, stream.job.whole_last_day)
    bucketed = with_time_bucket(events, stream.job.events_time_aggregation).where(F.col("events_time_bucket").isNotNull())
    watermarked = bucketed.withWatermark("events_time_bucket", stream.delay)
    return watermarked.groupBy(*COUNTED).agg(F.count(F.lit(1)).alias("num_events"))


def _write_buckets(closed: DataFrame, job: AuditJob) -> None:
    """Facet counts of the buckets that a batch closed, looked up in the lists as they are now."""
    if closed.isEmpty():
        return
    spark = closed.sparkSession
    counts = facets_of_counted(
        closed,
        accounts=read_accounts(spark, job.accounts_path) if job.accounts_path else None,
        user_types=read_user_types(spark, job.additional_user_info_path),
        known_projects=broadcast_if_small(read_known_projects(spark, job.known_projects_path)) if job.known_projects_path else None,
    )
    placed = counts.withColumn(_BUCKET_DIRECTORY, F.date_format("events_time_bucket", "yyyyMMddHHmmss"))
    # By range, a quiet bucket is one file and a busy one is cut at other facets; by the shuffle of the
    # count, every task would write a file for every bucket.
    placed = placed.repartitionByRange(*dict.fromkeys(["events_time_bucket", *FACETS]))
    writer = placed.write.format(job.index.format).mode("overwrite").partitionBy(_BUCKET_DIRECTORY)
    writer.options(**job.index.options).option("partitionOverwriteMode", "dynamic").save(job.index.path)


def start_audit_stream(spark: SparkSession, stream: AuditStream, available_now: bool = False) -> StreamingQuery:
    """Start the job; with `available_now` it ends when the files that are there have been counted.

    What is open at the end stays in the checkpoint and goes on with the next start.
    """
    closed = count_closed_buckets(read_audit_lines(configure(spark), stream.job.events_path, stream.max_files), stream)
    writer = closed.writeStream.outputMode("append").option("checkpointLocation", stream.checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, _: _write_buckets(batch, stream.job)).start()


def read_closed_counts(spark: SparkSession, stream: AuditStream) -> DataFrame:
    """Facet counts of all buckets closed so far."""
    return spark.read.format(stream.job.index.format).load(stream.job.index.path).drop(_BUCKET_DIRECTORY)
