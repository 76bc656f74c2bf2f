"""Longest known project at the start of a text, by sorting projects and texts together.

A project leads a text when the text, with a separator behind it, starts with the project with a
separator behind it. In the order of such keys all projects that lead a text also lead (or are) the
last project before it: what stands between a key and one of its beginnings has that beginning too.
So every project carries the list of those that enclose it, the last list is carried forward over the
texts, and a text takes the longest project of it that leads the text. A text yields no list of names
to try, however many separators it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import project_fields
from .known_projects import LONGEST, with_longest_known

#: Texts from which the bounds of the slices are taken, and letters of a bound; both only balance the slices.
SAMPLE_TEXTS = 10_000
BOUND_LETTERS = 64


def _key(text: str, separator: str) -> Column:
    return F.concat(F.rtrim(F.col(text), F.lit(separator)), F.lit(separator))


def _with_enclosing(known: DataFrame, separator: str) -> DataFrame:
    """(`_key`, `_chain`) per project: itself and the projects that lead it, the longest first."""
    names = known.select("name").where(F.col("name").isNotNull()).distinct()
    # With one more token behind it, the runs of a name are itself and its beginnings, separators at its end included.
    runs = project_fields.leading_runs(F.concat("name", F.lit(separator + "x")), separator, F.col(LONGEST[separator]))
    beginnings = with_longest_known(names, names).select("name", F.explode(runs).alias("_run"))
    chains = beginnings.join(names.select(F.col("name").alias("_run")), "_run").groupBy("name").agg(F.sort_array(F.collect_list("_run"), asc=False).alias("_chain"))
    return chains.select(F.concat("name", F.lit(separator)).alias("_key"), "_chain")


def _bounds(keys: DataFrame, slices: int) -> Column:
    """Ascending keys that cut the texts into slices of about equal size, from a sample by hash."""
    sample = keys.select(F.substring("_key", 1, BOUND_LETTERS).alias("_key")).orderBy(F.xxhash64("_key")).limit(SAMPLE_TEXTS)
    ordered = sample.agg(F.sort_array(F.collect_list("_key")).alias("keys"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(slices - 1)), lambda i: F.get("keys", F.floor(i * F.size("keys") / slices).cast("int")))
    return ordered.select(F.array_distinct(F.filter(cuts, lambda c: c.isNotNull())).alias("bounds")).scalar()


def match_leading_in_order(df: DataFrame, text: str, known: DataFrame, separator: str = ".", output: str = "project", slices: int = 200) -> DataFrame:
    """Add the longest run of leading tokens of `text` that is a known project, as `match_leading` does.

    Null texts have none, rows keep their number, repeated names count once. Distinct texts are
    sorted, in slices of the order whose bounds come from a sample of them; what a slice starts with
    is one row per slice. The rows get their project by a join on the text, which carries no hint:
    adaptive execution splits a text that holds a third of the rows.
    """
    texts = df.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct().withColumn("_key", _key("_text", separator))
    bounds = _bounds(texts, max(slices, 2))

    def sliced(frame: DataFrame) -> DataFrame:
        own = frame.withColumn("_bounds", bounds)
        return own.withColumn("_slice", F.size(F.filter("_bounds", lambda b: b <= F.col("_key")))).drop("_bounds")

    names = sliced(_with_enclosing(known, separator))
    lasts = names.groupBy("_slice").agg(F.max_by("_chain", "_key").alias("_chain"))
    numbers = df.sparkSession.range(max(slices, 2)).select(F.col("id").cast("int").alias("_slice"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    starts = numbers.join(lasts, "_slice", "left").select("_slice", F.last("_chain", ignorenulls=True).over(before).alias("_chain"))

    order = F.when(F.col("_text").isNull(), 0).otherwise(1)
    lines = sliced(texts).unionByName(names, allowMissingColumns=True).unionByName(starts.where("_chain IS NOT NULL"), allowMissingColumns=True)
    so_far = Window.partitionBy("_slice").orderBy(F.col("_key").asc_nulls_first(), order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = lines.select("_text", "_key", F.last("_chain", ignorenulls=True).over(so_far).alias("_chain")).where("_text IS NOT NULL")
    leads = F.filter("_chain", lambda name: F.startswith(F.col("_key"), F.concat(name, F.lit(separator))))
    found = carried.select("_text", F.get(leads, F.lit(0)).alias(output)).where(F.col(output).isNotNull())
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    return rows.join(found, "_text", "left").select("_row.*", output)
