"""Hand-kept CSV lists: email aliases and user types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.users import DEFAULT_USER_TYPE
from ..schemas import USER_TYPES

ALIAS_COLUMNS = ["author", "email", "organization"]


def read_aliases(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Aliases by header name, all text; None when no list is configured. Malformed rows drop."""
    if path is None:
        return None
    rows = spark.read.csv(path, header=True, inferSchema=False, mode="DROPMALFORMED")
    missing = [name for name in ALIAS_COLUMNS if name not in rows.columns]
    if missing:
        raise ValueError(f"alias list {path} lacks the column(s) {', '.join(missing)}")
    return rows.select(*ALIAS_COLUMNS)


def read_user_types(spark: SparkSession, path: str | None) -> DataFrame | None:
    """One type per user id; None when no list is configured.

    The last row of an id counts, an empty type means the default one, and a row that does not fit
    the schema fails the load. Split start and row number order the rows of a file.
    """
    if path is None:
        return None
    rows = spark.read.csv(path, header=True, schema=USER_TYPES, mode="FAILFAST").select(
        "id",
        F.coalesce(F.col("type"), F.lit(DEFAULT_USER_TYPE)).alias("type"),
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("row_order"),
    )
    return rows.groupBy("id").agg(F.max_by("type", "row_order").alias("type"))
