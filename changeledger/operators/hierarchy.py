"""Projects that have parents: roots, depths and inherited values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir


def _written(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: each round starts from files, not from all rounds before."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def resolve_hierarchy(projects: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """(`name`, `root`, `depth`, `holder`, `in_cycle`) for each project (`name`, `parent`).

    `holder` is the nearest of the project and its ancestors that is a `name` in `values`, from which
    the project inherits; null without one. A project whose parent is null or not listed is a root, of
    depth 0. Projects on a cycle of parents, and below one, have no root, depth or holder; they are
    reported by `in_cycle`. Of several parents of one name the smallest counts; null names are left out.

    Every round each project takes over the pointer of the one it points to, so a chain is halved: the
    rounds grow with the logarithm of the depth, each an equi-join of the projects with themselves. A
    parent of very many projects is the many side of that join, which adaptive execution splits.
    """
    named = projects.where(F.col("name").isNotNull()).groupBy("name").agg(F.min("parent").alias("parent"))
    known = named.select(F.col("name").alias("_known"))
    marked = named.join(known, F.col("parent") == F.col("_known"), "left")
    spark = projects.sparkSession
    holders = spark.createDataFrame([], "_holder string") if values is None else values.select(F.col("name").alias("_holder")).distinct()
    is_root = F.col("_known").isNull()
    state = _written(
        marked.join(holders, F.col("name") == F.col("_holder"), "left").select(
            "name",
            F.when(is_root, F.col("name")).otherwise(F.col("_known")).alias("at"),
            F.when(is_root, 0).otherwise(1).cast("bigint").alias("hops"),
            F.col("_holder").alias("holder"),
            is_root.alias("ended"),
        ),
        "hierarchy",
    )
    count, reach = state.count(), 1
    while reach <= count and not state.where("NOT ended").isEmpty():
        ahead = state.select(F.col("name").alias("_at"), F.col("at").alias("_next"), F.col("hops").alias("_hops"), F.col("holder").alias("_holder"), F.col("ended").alias("_ended"))
        moved = state.where("NOT ended").join(ahead, F.col("at") == F.col("_at")).select(
            "name", F.col("_next").alias("at"), (F.col("hops") + F.col("_hops")).alias("hops"), F.coalesce("holder", "_holder").alias("holder"), F.col("_ended").alias("ended")
        )
        # Those that have ended keep their row; what they point to is a root.
        state = _written(state.where("ended").unionByName(moved), "hierarchy")
        reach *= 2
    ended = F.col("ended")
    # Roots stand in for what their pointers ended at: a root's own value reaches those below it.
    tops = state.where("ended AND name = at").select(F.col("name").alias("_root"), F.col("holder").alias("_root_holder"))
    resolved = state.join(tops, F.col("at") == F.col("_root"), "left")
    return resolved.select(
        "name",
        F.when(ended, F.col("at")).alias("root"),
        F.when(ended, F.col("hops")).alias("depth"),
        F.when(ended, F.coalesce("holder", "_root_holder")).alias("holder"),
        (~ended).alias("in_cycle"),
    )
