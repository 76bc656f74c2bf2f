"""Rows within intervals of time, such as commits in freeze or deployment windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import FIRST_SECOND, LAST_SECOND
from .broadcasting import broadcast_if_small

MINUTE_MS, HOUR_MS, DAY_MS = 60_000, 3_600_000, 24 * 3_600_000

#: Blocks of time from fine to coarse, each a whole number of the one before.
BLOCKS_MS = [DAY_MS, 32 * DAY_MS, 1024 * DAY_MS, 32768 * DAY_MS]

#: Spans that rows are summed up over, likewise, and the blocks of spans that are numbered.
SPANS_MS = [1, MINUTE_MS, HOUR_MS, DAY_MS, 32 * DAY_MS, 1024 * DAY_MS]
BLOCKS_OF_SPANS = [16, 512, 16384]


def _runs(start: Column, end: Column, sizes: list[int], reach: bool) -> list[tuple[int, Column, Column]]:
    """Runs of blocks (level, first, end) that hold the interval without overlap: coarse ones inside, finer ones towards its ends.

    With `reach`, blocks of the finest level, and only those, reach beyond the interval. A run may be empty.
    """
    runs, coarser = [], None
    for level in range(len(sizes) - 1, -1, -1):
        size = sizes[level]
        low, high = (F.floor(start / size), F.floor(end / size) + 1) if reach and level == 0 else (F.ceil(start / size), F.floor((end + 1) / size))
        if coarser is None:
            runs.append((level, low, high))
        else:
            inner_low, inner_high, ratio = coarser
            has_inner = inner_low < inner_high
            left_end = F.when(has_inner, inner_low * ratio).otherwise(high)
            right_start = F.when(has_inner, inner_high * ratio).otherwise(high)
            runs += [(level, low, left_end), (level, right_start, high)]
        # Finer levels need not cover this level's blocks, those that coarser ones stand for included.
        coarser = (low, high, size // sizes[level - 1] if level else 1)
    return runs


def _blocks_of_run(level: int, first: Column, after: Column) -> Column:
    blocks = F.when(first < after, F.sequence(first, after - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(blocks, lambda block: F.struct(F.lit(level).alias("level"), block.alias("block")))


def _cover(start: Column, end: Column, sizes: list[int]) -> Column:
    """The blocks of `_runs`. Their number grows with the logarithm of the length, up to the coarsest level."""
    return F.concat(*[_blocks_of_run(*run) for run in _runs(start, end, sizes, reach=True)])


def _bounds(start: str, end: str) -> tuple[Column, Column]:
    """First and last millisecond; open ends are those of the years 1 to 9999."""
    return F.coalesce(F.col(start), F.lit(FIRST_SECOND * 1000)), F.coalesce(F.col(end), F.lit(LAST_SECOND * 1000 + 999))


def within_intervals(
    rows: DataFrame, intervals: DataFrame, time: str, start: str, end: str, blocks: list[int] | None = None, by: tuple[str, str] | None = None
) -> DataFrame:
    """Each row joined with every interval that holds its `time`, both ends included.

    Times are epoch milliseconds. A null end is open; an interval that ends before it starts holds
    nothing, and a row without a time is in none. Columns of both sides must have different names.
    `by` names a column of the rows and one of the intervals that must be equal too.

    An interval is cut into blocks of days, months, years and lifetimes (or other `blocks`), a row has one
    block of each size, and equal blocks are joined; so neither a long interval nor many of them make a
    row meet more than those that hold it, and those that touch its day. The blocks of the intervals are
    broadcast within a measured size; beyond it both sides are sorted, and a day with a third of the rows
    is split by adaptive execution. Spark's own estimate takes an interval for one row, not for its
    blocks, so the choice is not left to it.
    """
    sizes = blocks or BLOCKS_MS
    lower, upper = _bounds(start, end)
    covered = intervals.select(*intervals.columns, lower.alias("_lower"), upper.alias("_upper")).where("_lower <= _upper")
    cut = covered.select("*", F.explode(_cover(F.col("_lower"), F.col("_upper"), sizes)).alias("_cut")).select("*", F.col("_cut.level").alias("_level"), F.col("_cut.block").alias("_block")).drop("_cut")
    own = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col(time) / size).alias("block")) for level, size in enumerate(sizes)])
    placed = rows.where(F.col(time).isNotNull()).select(*rows.columns, F.explode(own).alias("_own"))
    same = (F.col("_own.level") == F.col("_level")) & (F.col("_own.block") == F.col("_block"))
    if by:
        same = same & (F.col(by[0]) == F.col(by[1]))
    # A broadcast that is hinted goes before the merge.
    met = placed.hint("merge").join(broadcast_if_small(cut), same)
    return met.where(F.col(time).between(F.col("_lower"), F.col("_upper"))).select(*rows.columns, *intervals.columns)


def summarize_within_intervals(rows: DataFrame, intervals: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """`within_intervals` grouped by the columns of the intervals: `num_rows`, `first` and `last` time.

    Pairs of rows and intervals grow with the product of both, so rows are summed up first: over equal
    times, minutes, hours, days and longer spans. An interval takes the longest spans inside it, shorter
    ones towards its ends, and single times last; these are its runs of numbered spans, and
    `within_intervals` joins both. So it meets some dozens of spans of each length, however many rows
    they have. Intervals that hold no row are left out.
    """
    at = F.col(time).cast("bigint")
    times = rows.where(at.isNotNull()).groupBy(at.alias("_time")).agg(F.count(F.lit(1)).alias("_rows"))
    numbers = F.array(*[F.struct(F.lit(span).alias("_span"), F.floor(F.col("_time") / size).alias("_number")) for span, size in enumerate(SPANS_MS)])
    spans = times.select("_time", "_rows", F.inline(numbers)).groupBy("_span", "_number").agg(F.sum("_rows").alias("_rows"), F.min("_time").alias("_first"), F.max("_time").alias("_last"))
    runs = [
        F.struct(F.lit(span).alias("_span_of_run"), first.alias("_from"), (after - 1).alias("_to"))
        for span, first, after in _runs(*_bounds(start, end), SPANS_MS, reach=False)
    ]
    pieces = intervals.select(*intervals.columns, F.inline(F.array(*runs))).where("_from <= _to")
    met = within_intervals(spans, pieces, "_number", "_from", "_to", BLOCKS_OF_SPANS, ("_span", "_span_of_run"))
    return met.groupBy(*intervals.columns).agg(F.sum("_rows").alias("num_rows"), F.min("_first").alias("first"), F.max("_last").alias("last"))
