"""Numbering rows in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeledger.operators.broadcasting import broadcast_if_small

from .batches import stored

#: monotonically_increasing_id counts rows of a partition in the lower bits.
ROW_BITS = 33


def numbered(frame: DataFrame, group: str, keys: list[str], label: str) -> DataFrame:
    """Add `position` (from 0) within `group` in the order of `keys`, and the group's `size`.

    Rows are dealt by ranges of (group, keys), sorted and written once, so a group that holds most
    rows is spread over many tasks. Only the row counts per group and partition meet in windows:
    at most one for each partition in a group. A null group is a group; rows that agree in all keys
    are ordered at will.
    """
    dealt = frame.repartitionByRange(group, *keys).sortWithinPartitions(group, *keys)
    placed = stored(dealt.withColumn("_row", F.monotonically_increasing_id()), label)
    runs = placed.groupBy(group, F.shiftright("_row", ROW_BITS).alias("_part")).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    so_far, whole = Window.partitionBy(group).orderBy("_part"), Window.partitionBy(group)
    shifts = stored(
        runs.select(
            F.col(group).alias("_group"),
            "_part",
            (F.sum("_rows").over(so_far) - F.col("_rows") - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(whole).alias("size"),
        ),
        label,
    )
    same_run = F.col(group).eqNullSafe(F.col("_group")) & (F.shiftright("_row", ROW_BITS) == F.col("_part"))
    positioned = placed.join(broadcast_if_small(shifts), same_run)
    return positioned.select(*frame.columns, (F.col("_row") + F.col("_shift")).alias("position"), "size")
