"""User identifier and user type of audit events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_USER_TYPE = "human"


def with_user_columns(
    events: DataFrame, accounts: DataFrame | None = None, user_types: DataFrame | None = None
) -> DataFrame:
    """Both user columns with a single lookup on `who`.

    The two dimensions share their key, so they are merged first and the events are joined once:
    if the directory is too large to broadcast, the events are shuffled once instead of twice, and
    that one join is of the form adaptive execution can split when a user dominates.
    """
    who = F.col("who")
    directory = None
    if accounts is not None:
        directory = accounts.select(F.col("account_id").alias("_who"), F.col("identifier").alias("_identifier"))
    if user_types is not None:
        types = user_types.select(F.col("id").alias("_who"), F.col("type").alias("_type"))
        directory = types if directory is None else directory.join(types, "_who", "full")
    if directory is not None:
        events = events.join(directory, who == F.col("_who"), "left")
    identifier = F.col("_identifier") if accounts is not None else F.lit(None)
    user_type = F.col("_type") if user_types is not None else F.lit(None)
    return events.withColumns(
        {
            "user_identifier": F.coalesce(identifier, who.cast("string")),
            "user_type": F.when(who.isNotNull(), F.coalesce(user_type, F.lit(DEFAULT_USER_TYPE))),
        }
    ).drop("_who", "_identifier", "_type")


def with_user_identifier(events: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Identifier of a known account, the decimal id of an unknown one, null without a user."""
    return with_user_columns(events, accounts).select(*events.columns, "user_identifier")


def with_user_type(events: DataFrame, user_types: DataFrame | None = None) -> DataFrame:
    """Listed type, `human` for unlisted users, null without a user."""
    return with_user_columns(events, user_types=user_types).select(*events.columns, "user_type")
