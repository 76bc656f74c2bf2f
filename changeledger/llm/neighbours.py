"""Nearest neighbours by inner product, with a forest of sorted hash prefixes.

Each tree hashes a vector to a long bit string by the signs of random projections, and is nothing
but the sorted array of the strings. A query descends every tree by binary search to its longest
matching prefix; then the prefix is shortened by one bit in all trees at once, which widens each
range of the arrays, until the ranges hold enough candidates. The candidates are ranked by the
exact inner product.

The vectors are dealt over shards, each with a forest of its own; a block of queries meets every
shard, and the best of all shards are merged. For inner products of vectors of different length the
vectors get one more component that makes all lengths equal, so that the nearest by angle are the
largest by inner product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

_BITS = 32


@dataclass(frozen=True)
class Settings:
    """Trees, and the share of a shard's vectors that a query takes as candidates at least.

    Near neighbours among vectors without clusters share few bits, so the share decides the recall:
    see the test against brute force. `shard_rows` vectors and `block_rows` queries meet in a task.
    """

    trees: int = 48
    share: float = 0.55
    least: int = 200
    shard_rows: int = 8192
    block_rows: int = 4096
    seed: int = 11


class Forest:
    """Sorted arrays of hash strings over the vectors of a shard."""

    def __init__(self, vectors: np.ndarray, settings: Settings, longest: float) -> None:
        self.settings = settings
        random = np.random.RandomState(settings.seed)
        self.planes = random.normal(size=(settings.trees, vectors.shape[1] + 1, _BITS))
        lift = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
        self.orders, self.keys = [], []
        for keys in self._strings(np.hstack([vectors, lift[:, None]])):
            order = np.argsort(keys, kind="stable")
            self.orders.append(order)
            self.keys.append(keys[order])
        self.count = len(vectors)

    def _strings(self, lifted: np.ndarray) -> list[np.ndarray]:
        weights = np.uint64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.uint64)
        return [((lifted @ planes > 0) * weights).sum(axis=1, dtype=np.uint64) for planes in self.planes]

    def candidates(self, queries: np.ndarray) -> list[np.ndarray]:
        """Positions of the candidates of each query: all, where the forest has not enough."""
        wanted = max(self.settings.least, int(self.settings.share * self.count))
        strings = self._strings(np.hstack([queries, np.zeros((len(queries), 1))]))
        low = np.zeros((_BITS + 1, len(strings), len(queries)), np.int32)
        high = np.zeros_like(low)
        for depth in range(_BITS + 1):
            rest = np.uint64(_BITS - depth)
            for t, own in enumerate(strings):
                first = own >> rest << rest
                low[depth, t] = np.searchsorted(self.keys[t], first, side="left")
                high[depth, t] = np.searchsorted(self.keys[t], first + (np.uint64(1) << rest), side="left")
        found = []
        for q in range(len(queries)):
            ranges = (high[:, :, q] - low[:, :, q]).sum(axis=1)
            # The ranges of all trees together count a vector once per tree: go up until enough are distinct.
            depth = int(np.flatnonzero(ranges >= min(wanted, self.count))[-1])
            while True:
                marked = np.zeros(self.count, bool)
                for t, order in enumerate(self.orders):
                    marked[order[low[depth, t, q] : high[depth, t, q]]] = True
                if depth == 0 or marked.sum() >= wanted:
                    break
                depth -= 1
            found.append(np.flatnonzero(marked))
        return found


_FOUND = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])


def _valid(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of usable rows: finite components, none null, not all zero."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), vector.alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def nearest(vectors: DataFrame, queries: DataFrame, count: int = 20, settings: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the `count` largest inner products found of each query.

    Nearest first, ties to the smaller id; a query's own id is no candidate. Rows whose vector is
    null, zero or holds a null or non-finite component take no part, nor do rows without an id;
    repeated rows count once, by id. Vectors of another length than the query's are never its
    candidates. Fewer than `count` rows if there are fewer candidates.
    """
    usable = _valid(vectors, id_column, vector_column).groupBy("vec_id").agg(F.first("vector").alias("vector")).withColumn("size", F.size("vector"))
    asked = _valid(queries, id_column, vector_column).groupBy("vec_id").agg(F.first("vector").alias("vector")).withColumn("size", F.size("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    total, longest = usable.agg(F.count("*"), F.max(square)).first()
    shards = -(-total // settings.shard_rows) or 1
    blocks = -(-asked.count() // settings.block_rows) or 1
    longest = float(longest or 0) ** 0.5

    # Every shard meets every block: shards are repeated per block, queries per shard.
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    dealt = usable.select("size", shard, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "vector")
    sent = asked.select("size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block, "vec_id", "vector")

    def search(rows, wanted):  # no annotations: Spark would read them
        ids, query_ids = rows.column("vec_id").to_numpy(), wanted.column("vec_id").to_numpy()
        if not len(ids) or not len(query_ids):
            return pa.table([pa.array([], f) for f in (pa.int64(), pa.int64(), pa.float64())], names=_FOUND.names)
        data = np.array(rows.column("vector").to_pylist(), float)
        forest = Forest(data, settings, longest)
        out_queries, out_ids, out_scores = [], [], []
        asked_vectors = np.array(wanted.column("vector").to_pylist(), float)
        for start in range(0, len(query_ids), 256):
            part = asked_vectors[start : start + 256]
            for query_id, query, near in zip(query_ids[start : start + 256].tolist(), part, forest.candidates(part), strict=True):
                near = near[ids[near] != query_id]
                scores = data[near] @ query
                if len(near) > 2 * count:
                    # Sums in another order differ in the last bits; keep all that could be among the best.
                    least = np.partition(scores, -count)[-count]
                    near = near[scores >= least - 1e-9 * (1 + abs(least))]
                exact = (data[near] * query).cumsum(axis=1)[:, -1]
                best = np.lexsort((ids[near], -exact))[:count]
                out_queries += [query_id] * len(best)
                out_ids += ids[near[best]].tolist()
                out_scores += exact[best].tolist()
        return pa.table([pa.array(out_queries, pa.int64()), pa.array(out_ids, pa.int64()), pa.array(out_scores, pa.float64())], names=_FOUND.names)

    keys = ["size", "shard", "block"]
    found = dealt.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(search, _FOUND)
    # The best of each shard are at most `count`; they are ranked without gathering more per query.
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("n"), "vec_id"))), 1, count).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("position", "hit")).select("query_id", (F.col("position") + 1).cast(IntegerType()).alias("rank"), "hit.vec_id", (-F.col("hit.n")).alias("score"))
