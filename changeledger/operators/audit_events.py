"""Audit lines to flat events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..schemas import AUDIT_EVENT_COLUMNS, AUDIT_LINE
from ..session import require_utc

# Record type in the log -> audit type in the result.
AUDIT_TYPES = {
    "HttpAuditEvent": "HTTP",
    "ExtendedHttpAuditEvent": "EXTENDED_HTTP",
    "SshAuditEvent": "SSH",
}

# Columns without which a line is not an event.
REQUIRED = ["session_id", "time_at_start", "what", "elapsed", "uuid", "result", "audit_type"]


def parse_audit_lines(lines: DataFrame) -> DataFrame:
    """`value` lines to events; lines that are not complete audit events are dropped.

    `who`, `access_path` are optional; HTTP events also need a method and carry the HTTP status
    as their result. SSH events have a null `http_method`.
    """
    whole = _once(lines).where(_ends_a_document(F.col("value")))
    listed = whole.select(F.inline(F.array(F.struct(_documents(F.col("value")).alias("documents")))))
    events = _event_columns(listed.where(F.size("documents") == 1).select(F.col("documents")[0].alias("line")).select("line.*"))
    return events.where(_is_complete())


def _once(lines: DataFrame) -> DataFrame:
    """The lines through a generator, which keeps a computed line from being computed again for each use."""
    return lines.select(F.explode(F.array("value")).alias("value"))


def _ends_a_document(value: Column) -> Column:
    """The last character tells a bracket that would close the array of `_documents` early."""
    return F.rtrim(value, F.lit(" \t\r")).endswith("}")


def _documents(value: Column) -> Column:
    """A line read as the elements of an array: more than one, or anything after it, does not count as an event."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), f"array<struct<{AUDIT_LINE}>>", {"allowSingleQuotes": "false"})


def _event_columns(parsed: DataFrame, kept: list[str] | None = None) -> DataFrame:
    audit_type = F.lit(None).cast("string")
    for record_type, name in AUDIT_TYPES.items():
        audit_type = F.when(F.col("type") == record_type, F.lit(name)).otherwise(audit_type)
    is_ssh = F.col("type") == "SshAuditEvent"
    return parsed.select(
        *(kept or []),
        F.col("event.who.access_path").alias("access_path"),
        F.col("event.session_id").alias("session_id"),
        F.col("event.who.account_id.id").alias("who"),
        F.col("event.time_at_start").alias("time_at_start"),
        F.col("event.what").alias("what"),
        F.col("event.elapsed").alias("elapsed"),
        F.col("event.uuid.uuid").alias("uuid"),
        F.when(~is_ssh, F.col("event.http_method")).alias("http_method"),
        F.when(is_ssh, F.col("event.result")).otherwise(F.col("event.http_status")).alias("result"),
        audit_type.alias("audit_type"),
    )


def _is_complete() -> Column:
    complete = (F.col("audit_type") == "SSH") | F.col("http_method").isNotNull()
    for name in REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return complete


def count_rejected_lines(lines: DataFrame) -> DataFrame:
    """(`reason`, `num_lines`) of the lines that are no complete audit events, blank ones included.

    The reason is the first that holds: `no document` (not one JSON object), `unknown type`, or the
    field that is missing or of a wrong type.
    """
    ended = F.when(_ends_a_document(F.col("value")), _documents(F.col("value")))
    listed = _once(lines).select(F.inline(F.array(F.struct(ended.alias("documents")))))
    one = F.when(F.size("documents") == 1, F.col("documents")[0])
    events = _event_columns(listed.select(one.alias("line")).select(F.col("line").isNull().alias("_none"), "line.*"), ["_none"])
    reason = F.when(F.col("_none"), "no document").when(F.col("audit_type").isNull(), "unknown type")
    for name in REQUIRED:
        reason = reason.when(F.col(name).isNull(), F.lit(name))
    rejected = events.select(F.coalesce(_is_complete(), F.lit(False)).alias("_complete"), reason.otherwise("http_method").alias("reason"))
    return rejected.where("NOT _complete").groupBy("reason").agg(F.count(F.lit(1)).alias("num_lines"))


def audit_documents(events: DataFrame) -> DataFrame:
    """One canonical JSON document per event; absent values are left out of it."""
    return events.select(F.to_json(F.struct(*AUDIT_EVENT_COLUMNS)).alias("document"))


def col_or_null(df: DataFrame, name: str, data_type: str = "string") -> Column:
    """The column, or a typed null when the frame lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(data_type)


def with_event_columns(df: DataFrame) -> DataFrame:
    """Complete a caller's event frame with the optional columns it lacks."""
    optional = {"who": "int", "access_path": "string", "http_method": "string"}
    lacking = {name: col_or_null(df, name, kind) for name, kind in optional.items() if name not in df.columns}
    return df.withColumns(lacking) if lacking else df


def filter_time_range(
    events: DataFrame, since: str | dt.date | None = None, until: str | dt.date | None = None, whole_last_day: bool = False
) -> DataFrame:
    if since is None and until is None:
        return events
    return events.where(times.within_range(F.col("time_at_start"), since, until, whole_last_day))


def with_time_bucket(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Add the bucket of the start time; the session must read times as UTC."""
    return require_utc(events).withColumn("events_time_bucket", times.time_bucket(F.col("time_at_start"), unit))
