"""Sessions of audit users: runs of events with no longer pause than a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import epoch_ms_to_timestamp
from ..session import require_utc

DAY_MS = 24 * 3_600_000


def user_sessions(events: DataFrame, gap_ms: int, slice_ms: int = DAY_MS) -> DataFrame:
    """(`who`, `session_start`, `session_end`, `num_events`, `total_elapsed`, `num_failed`) per session.

    A session ends before an event that starts more than `gap_ms` after the one before it; start and end
    are the first and last start times, in epoch milliseconds. Events without a user belong to none;
    nor do times outside the years 1 to 9999. A failed event has another result than 0 or below 400.

    Events are merged into sessions within slices of time first, so a user with a third of all events
    is spread over tasks. What crosses a border between slices is then joined from one row per partial
    session, of which a user has at most one for each gap.
    """
    if gap_ms <= 0:
        raise ValueError(f"a gap must be longer than nothing, not {gap_ms} ms")
    started = epoch_ms_to_timestamp(F.col("time_at_start"))
    timed = require_utc(events).where(F.col("who").isNotNull()).withColumn("_started", started).where(F.col("_started").isNotNull())
    status = F.col("result").try_cast("int")
    failed = ~F.coalesce((status == 0) | status.between(100, 399), F.lit(False))
    partial = (
        timed.withColumn("_slice", F.floor(F.col("time_at_start") / slice_ms))
        .groupBy("who", "_slice", F.session_window("_started", f"{gap_ms} milliseconds"))
        .agg(
            F.min("time_at_start").alias("session_start"),
            F.max("time_at_start").alias("session_end"),
            F.count(F.lit(1)).alias("num_events"),
            F.sum(F.col("elapsed").cast("bigint")).alias("total_elapsed"),
            F.count_if(failed).alias("num_failed"),
        )
    )
    in_order = Window.partitionBy("who").orderBy("session_start")
    paused = F.col("session_start") - F.lag("session_end").over(in_order) > gap_ms
    marked = partial.withColumn("_new", F.coalesce(paused, F.lit(True)).cast("bigint"))
    numbered = marked.withColumn("_session", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (
        numbered.groupBy("who", "_session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            *[F.sum(name).alias(name) for name in ("num_events", "total_elapsed", "num_failed")],
        )
        .drop("_session")
    )
