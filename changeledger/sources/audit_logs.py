"""Audit logs: text files, plain or compressed, one JSON event per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit_events import parse_audit_lines


def read_audit_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events of a file or directory.

    A `.gz` file is one split. Raw lines are deliberately not redistributed after the read: the
    first aggregation of the audit plan shuffles counts, which are far smaller than the text.
    """
    return parse_audit_lines(spark.read.text(path))
