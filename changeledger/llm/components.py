"""Connected components of a large undirected graph, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import stored

MAX_ROUNDS = 60


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node that is reachable.

    Loops and repeated edges are allowed; no edges give no rows. Each round hangs neighbours under
    the least node around, so the depth shrinks fast; a round's edges are written to the shared
    scratch folder. No neighbourhood is gathered: a node with very many edges is a minimum that is
    aggregated map-side and a join that adaptive execution splits.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    links = stored(links, "components")
    before = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.filter("u <> v")
        small = _with_least(down).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        links = stored(small.filter("u <> v").distinct(), "components")
        after = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if after == before:
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = after
    raise RuntimeError(f"components not stable after {MAX_ROUNDS} rounds")
