"""As-of joins: the value that a key had at the time of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contributors import alias_overrides
from .users import DEFAULT_USER_TYPE

DAY_MS = 24 * 3_600_000


def with_value_as_of(
    rows: DataFrame, history: DataFrame, key: str, time: str, valid_from: str, values: list[str], slice_ms: int = DAY_MS
) -> DataFrame:
    """Add the `values` of the latest history entry of the row's key that is not after the row.

    `rows` keep their columns and their number; `time` and `valid_from` are epoch milliseconds, and an
    entry holds from its own millisecond on. Rows without a key, a time or an earlier entry get nulls.
    Of several entries of one key and time the greatest values count.

    Rows and entries are brought together by union and the last entry is carried forward, so no row
    meets a range of entries. They are grouped by key and slice of time: a key that holds a third of
    the rows is spread over its slices. What a slice starts with is found beforehand, from one row per
    key and slice; take slices in which the busiest key fits into a task.
    """

    def slice_of(at: Column) -> Column:
        return F.floor(at / slice_ms)

    entries = (
        history.select(F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.struct(*values).alias("_value"))
        .where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
        .groupBy("_key", "_at")
        .agg(F.max("_value").alias("_value"))
        .withColumn("_slice", slice_of(F.col("_at")))
    )
    placed = rows.select(F.struct(*rows.columns).alias("_row"), F.col(key).alias("_key"), F.col(time).alias("_at")).withColumn("_slice", slice_of(F.col("_at")))
    located = F.col("_key").isNotNull() & F.col("_at").isNotNull()

    lasts = entries.groupBy("_key", "_slice").agg(F.max_by("_value", "_at").alias("_value"))
    with_rows = placed.where(located).select("_key", "_slice", F.lit(True).alias("_has_rows")).distinct()
    steps = lasts.join(with_rows, ["_key", "_slice"], "full")
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select("_key", "_slice", "_has_rows", F.last("_value", ignorenulls=True).over(before).alias("_value"))

    none = F.lit(None)
    # Within a slice: what it starts with, then entries, each before the rows of its millisecond.
    starts = carried.where("_has_rows AND _value IS NOT NULL").select("_key", "_slice", none.cast("bigint").alias("_at"), F.lit(0).alias("_order"), "_value")
    changes = entries.select("_key", "_slice", "_at", F.lit(0).alias("_order"), "_value")
    own = placed.select("_key", "_slice", "_at", F.lit(1).alias("_order"), "_row", F.when(~located, F.xxhash64("_row")).alias("_spread"))
    timeline = own.unionByName(starts, allowMissingColumns=True).unionByName(changes, allowMissingColumns=True)
    # Rows without a key or a time have nothing to look up; a hash keeps them from meeting in one task.
    so_far = Window.partitionBy("_key", "_slice", "_spread").orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = timeline.select("_order", "_row", F.last("_value", ignorenulls=True).over(so_far).alias("_value")).where("_order = 1")
    return filled.select("_row.*", "_value.*")


def with_user_type_as_of(events: DataFrame, history: DataFrame, slice_ms: int = DAY_MS) -> DataFrame:
    """`user_type` of `who` when the event started, from (`id`, `valid_from`, `type`) entries.

    As without dates, users that are not listed (yet) or whose type is null are human, and events
    without a user have no type.
    """
    entries = history.select(F.col("id").alias("who"), "valid_from", F.col("type").alias("_type"))
    found = with_value_as_of(events, entries, "who", "time_at_start", "valid_from", ["_type"], slice_ms)
    user_type = F.when(F.col("who").isNotNull(), F.coalesce("_type", F.lit(DEFAULT_USER_TYPE)))
    return found.select(*events.columns, user_type.alias("user_type"))


def apply_aliases_as_of(rows: DataFrame, history: DataFrame, time: str = "last_commit_date", slice_ms: int = 30 * DAY_MS) -> DataFrame:
    """Override author and organisation by the alias that the email had at `time`.

    `history` has (`email`, `valid_from`, `author`, `organization`); what an entry overrides is the
    same as for aliases without dates, but an email has one alias at a time.
    """
    entries = history.select("email", "valid_from", F.col("author").alias("_alias_author"), F.col("organization").alias("_alias_organization"))
    found = with_value_as_of(rows, entries, "email", time, "valid_from", ["_alias_author", "_alias_organization"], slice_ms)
    return found.select(*[alias_overrides().get(c, F.col(c)) for c in rows.columns])
