"""One parse per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inline_json(
    df: DataFrame, text: str, schema: str, keep: list[str] | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """The `keep` columns followed by the top-level fields of the JSON in column `text`.

    Going through a generator rather than a plain projection matters: a later filter on parsed
    fields would otherwise be pushed through the projection by inlining `from_json` once per
    condition, parsing every line many times over. Text that does not parse gives nulls.
    """
    parsed = F.from_json(F.col(text), schema, {"mode": "PERMISSIVE", **(options or {})})
    return df.select(*(keep or []), F.inline(F.array(parsed)))
