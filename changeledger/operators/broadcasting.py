"""Broadcast behind a measured bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 << 20
_ROW_OVERHEAD_BYTES = 32


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast of a list of texts whose measured size is within the limit.

    For lists joined with raw lines, where a shuffle would move the lines themselves: Spark's own
    threshold is far lower, and a conversion at run time comes after the lines were shuffled. The
    list is read once to add up its bytes. A larger one is returned as it is, for Spark to join by
    shuffle and split where skewed.
    """
    row_bytes = F.lit(_ROW_OVERHEAD_BYTES)
    for name in df.columns:
        row_bytes = row_bytes + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    measured = df.agg(F.sum(row_bytes.cast("bigint")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if measured <= limit_bytes else df
