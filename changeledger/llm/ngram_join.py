"""All links of documents whose sets of word n-grams have a high Jaccard similarity.

All n-grams have one global order, which is cut into fragments; what a set has in one fragment is a
segment. The overlap of a candidate pair is counted in each fragment by itself, and the counts are
summed per pair.

Candidates are found without loss. Linked sets share one of the first n-grams of the global order
(the prefix). The order begins with the n-grams that only one set of all has: those are never
shared, so they need no partner, and a text with enough of them has none. Each chunk of documents
sends its sorted distinct n-grams once, packed, to learn which are repeated elsewhere. Among the
repeated ones those that a sample shows to be common come last; any such order gives the same links.
Two numbers bound how alike two sets can be before they are compared: the n-grams that only one of
them has at all, and the bits in which small parity sketches of their repeated n-grams differ (an
n-gram that one of them lacks flips one bit). Both never exceed the true difference.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from changeledger.operators.broadcasting import broadcast_if_small

from .batches import as_bytes, grouped, id_and_text, stored, with_row
from .components import components
from .hashing import mixed
from .sorted_runs import RUNS, merge_runs, names_bits, repeated_names, rows_of, sorted_runs, texts_of, with_answers, written_chunks

#: 64-bit words of a parity sketch.
SKETCH_WORDS = 8
#: Bytes of text whose n-grams one merging task holds, about.
_BYTES_PER_RANGE = 16 << 20
#: Fragments in which the overlap of a pair is counted.
COUNT_FRAGMENTS = 16
#: Expected number of distinct texts in the sample; an n-gram that so many of them have is common.
SAMPLE_TEXTS = 16_000
COMMON_TEXTS = 3
#: Bound of the common n-grams; the most frequent are taken.
MAX_COMMON = 200_000


@dataclass(frozen=True)
class Similarity:
    """Link when `scale * intersection >= least * union`; `words` make an n-gram."""

    words: int = 5
    least: int = 80
    scale: int = 100

    def prefix(self, size: int) -> int:
        """How many of the first n-grams of two linked sets include a common one."""
        return size - -(-size * self.least // self.scale) + 1

    def possible(self, sizes: Column, difference: Column) -> Column:
        """Whether two sets can link, from the sum of their sizes and a number they differ in at least."""
        return difference * (self.scale + self.least) <= sizes * (self.scale - self.least)


class _WordHashes(dict):
    """Hashes of words; one that is missing is computed when it is asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Shingler:
    """Sorted distinct n-gram hashes of texts; a text with fewer words is one n-gram."""

    def __init__(self, words: int) -> None:
        self.words = words
        self._hash = _WordHashes()

    def grams(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(self._hash) > 200_000:
            self._hash.clear()
        hashes = np.fromiter(map(self._hash.__getitem__, words), np.uint64, len(words))
        size = min(self.words, len(words))
        count = len(words) - size + 1
        grams = np.full(count, size, np.uint64)
        for offset in range(size):
            grams = mixed(grams + hashes[offset : offset + count])
        grams.sort()
        first = np.ones(count, bool)
        np.not_equal(grams[1:], grams[:-1], out=first[1:])
        return grams[first]


@dataclass(frozen=True)
class Common:
    """N-grams in ascending order and in how many sampled texts they are."""

    grams: np.ndarray
    texts: np.ndarray

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """The number for each n-gram; 0 for those that are not common."""
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.texts[at], 0)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def common_grams(documents: DataFrame, similarity: Similarity) -> Common:
    """N-grams that several distinct texts of a sample have; at most MAX_COMMON."""
    total = documents.count()
    share = int((1 << 30) * min(1.0, SAMPLE_TEXTS / max(1, total)))
    sample = documents.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share).dropDuplicates(["text"])

    def list_grams(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(similarity.words)
        for batch in grouped(batches):
            grams = [shingler.grams(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(grams)))], names=["gram"])

    counted = sample.mapInArrow(list_grams, StructType([StructField("gram", LongType())])).groupBy("gram").agg(F.count("*").alias("n"))
    rows = counted.filter(F.col("n") >= COMMON_TEXTS).orderBy(F.desc("n"), "gram").limit(MAX_COMMON).collect()
    grams = np.array([row["gram"] for row in rows], np.int64).view(np.uint64)
    order = np.argsort(grams)
    return Common(grams[order], np.array([row["n"] for row in rows], np.int64)[order])


def _set_key(grams: np.ndarray) -> int | None:
    """A key of a set; null for an empty one."""
    if not len(grams):
        return None
    return int(_signed(mixed(np.add.reduce(mixed(grams ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True)))[0])


def marks_of(grams: np.ndarray, repeated: np.ndarray, common: Common, similarity: Similarity) -> np.ndarray:
    """The repeated n-grams of a set's prefix: linked sets that are not equal share one."""
    rest = grams[repeated]
    order = np.lexsort((rest, common.counts(rest)))
    return rest[order[: max(0, similarity.prefix(len(grams)) - (len(grams) - len(rest)))]]


def sketch(repeated: np.ndarray) -> np.ndarray:
    """For each bit whether an odd number of the n-grams falls on it."""
    size = 64 * SKETCH_WORDS
    odd = np.bincount((repeated & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _distinct_sets(texts: list[bytes], shingler: Shingler) -> tuple[list[int | None], list[int], dict[int, np.ndarray]]:
    """Key and size of each text's set, and the sets by key."""
    keys, sizes, sets = [], [], {}
    for text in texts:
        grams = shingler.grams(text)
        key = _set_key(grams)
        keys.append(key)
        sizes.append(len(grams))
        if key is not None:
            sets[key] = grams
    return keys, sizes, sets


_DESCRIBED = StructType(
    [StructField("doc_id", LongType()), StructField("n_shingles", LongType(), False), StructField("set_key", LongType()), StructField("own", LongType(), False), StructField("sketch", ArrayType(LongType(), False), False), StructField("marks", ArrayType(LongType(), False), False)]
)


def describe(documents: DataFrame, similarity: Similarity) -> DataFrame:
    """Per row of (doc_id, binary text): size and key of its set, how many n-grams no other has, sketch, marks.

    The key is null for an empty set. Of rows with one set in one chunk only the last has sketch and marks.
    Copies in different chunks count as sets that repeat each other: fewer n-grams are then their own,
    which loses no candidate.
    """
    chunks, total = written_chunks(documents)
    parts = int(total / _BYTES_PER_RANGE) + 1
    bits = names_bits(total)
    common = common_grams(documents, similarity)
    mask = ~np.uint64((1 << (64 - bits)) - 1)

    def names_of(sets: dict[int, np.ndarray]) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *sets.values()]) & mask

    def list_names(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(similarity.words)
        for row in rows_of(batches):
            yield sorted_runs(row["chunk"], names_of(_distinct_sets(texts_of(row), shingler)[2]), parts)

    repeated = stored(merge_runs(chunks.mapInArrow(list_names, RUNS), parts), "ngram-repeats")

    def describe_chunks(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(similarity.words)
        for row in rows_of(batches):
            keys, sizes, sets = _distinct_sets(texts_of(row), shingler)
            known = repeated_names(row["answers_0"], names_of(sets), parts)
            ends = np.cumsum([len(own) for own in sets.values()])
            own, sketches, marks = {}, {}, {}
            for (key, grams), end in zip(sets.items(), ends.tolist(), strict=True):
                flags = known[end - len(grams) : end]
                own[key] = len(grams) - int(flags.sum())
                sketches[key] = sketch(grams[flags])
                marks[key] = marks_of(grams, flags, common, similarity)
            listed = [marks.pop(key, np.zeros(0, np.uint64)) for key in reversed(keys)][::-1]
            offsets = pa.array(np.cumsum([0, *map(len, listed)]), pa.int32())
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array([own.get(key, 0) for key in keys], pa.int64())]
            last = {key: i for i, key in enumerate(keys)}
            columns.append(pa.array([sketches[key] if key is not None and last[key] == i else [] for i, key in enumerate(keys)], pa.list_(pa.int64())))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *listed])))))
            yield pa.RecordBatch.from_arrays(columns, names=_DESCRIBED.names)

    return with_answers(chunks, total, repeated).mapInArrow(describe_chunks, _DESCRIBED)


def _segments(documents: DataFrame, wanted: DataFrame, similarity: Similarity) -> DataFrame:
    """(set_key, fragment, grams) of the wanted sets, each taken from its document of least id."""
    schema = StructType([StructField("set_key", LongType()), StructField("fragment", IntegerType()), StructField("n_shingles", LongType()), StructField("grams", ArrayType(LongType(), False))])

    def cut(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(similarity.words)
        cuts = np.arange(1, COUNT_FRAGMENTS, dtype=np.uint64) << np.uint64(60)
        for batch in batches:
            keys, sizes, segments = [], [], []
            for key, text in zip(batch.column("set_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                grams = shingler.grams(text)
                if _set_key(grams) != key:
                    continue  # another text under the same id
                keys += [key] * COUNT_FRAGMENTS
                sizes += [len(grams)] * COUNT_FRAGMENTS
                segments += np.split(grams, np.searchsorted(grams, cuts))
            offsets = pa.array(np.cumsum([0, *map(len, segments)]), pa.int32())
            values = pa.array(_signed(np.concatenate(segments))) if segments else pa.array([], pa.int64())
            fragments = pa.array(list(range(COUNT_FRAGMENTS)) * (len(keys) // COUNT_FRAGMENTS), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), fragments, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, values)], names=schema.names)

    chosen = documents.select("doc_id", "text").join(broadcast_if_small(wanted), "doc_id").select("set_key", "text")
    return chosen.mapInArrow(cut, schema)


def linked_pairs(pairs: DataFrame, segments: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) of set keys that link: overlaps per fragment, summed per pair."""
    left = segments.select(F.col("set_key").alias("a"), "fragment", F.col("grams").alias("grams_a"), F.col("n_shingles").alias("n_a"))
    right = segments.select(F.col("set_key").alias("b"), "fragment", F.col("grams").alias("grams_b"), F.col("n_shingles").alias("n_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    both = F.sum("overlap")
    union = F.max("n_a") + F.max("n_b") - both
    summed = partial.groupBy("a", "b").agg(both.alias("both"), union.alias("union"))
    return summed.filter(F.col("both") * similarity.scale >= F.col("union") * similarity.least).select("a", "b")


def _pair(one: str, other: str) -> Column:
    """The keys of two sets, the smaller first."""
    return F.struct(F.least(f"{one}.set_key", f"{other}.set_key").alias("a"), F.greatest(f"{one}.set_key", f"{other}.set_key").alias("b")).alias("pair")


def _can_link(one: str, other: str, similarity: Similarity) -> Column:
    both = lambda name: F.col(f"{one}.{name}") + F.col(f"{other}.{name}")
    flipped = [F.bit_count(F.col(f"{one}.sketch")[i].bitwiseXOR(F.col(f"{other}.sketch")[i])) for i in range(SKETCH_WORDS)]
    return similarity.possible(both("n_shingles"), sum(flipped, both("own")))


def similar_components(documents: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """Per row of (doc_id, binary text): n_shingles and component_id.

    component_id is the smallest doc_id that is reachable by links, the row's own included; a text
    that is null, empty or without words links with nothing. Rows of equal sets are one class, so
    copies are never expanded into pairs. In a group of sets that share a mark each is first
    compared with one of them; only sets that are in different components after that are compared
    with each other. A row whose doc_id is null links through rows of an equal set that have one; its
    component_id is then theirs, else null. Different texts under one doc_id are different documents.
    """
    placed = _placed(documents, similarity)
    return placed.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _placed(documents: DataFrame, similarity: Similarity) -> DataFrame:
    """(doc_id, n_shingles, set_key, root, component_id) per row: `root` names the component, whatever its ids.

    Key, root and component are null for a text without words.
    """
    described = stored(describe(documents, similarity), "ngram-sets")
    sets = described.select("doc_id", "n_shingles", "set_key")
    classes = sets.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("first_id"))

    # The head of a mark is the set with the fewest n-grams of its own: it is the likeliest to link.
    marks = described.select(F.struct("own", "set_key", "n_shingles", "sketch").alias("set"), F.explode("marks").alias("mark"))
    group = Window.partitionBy("mark")
    headed = marks.withColumns({"head": F.min("set").over(group), "last": F.max("set").over(group)}).filter(F.col("head.set_key") != F.col("last.set_key"))
    shared = stored(headed.select("mark", "set", "head"), "ngram-marks")

    to_head = shared.filter((F.col("set.set_key") != F.col("head.set_key")) & _can_link("set", "head", similarity))
    first_pairs = stored(to_head.select(_pair("set", "head")).select("pair.*").distinct(), "ngram-pairs")
    shared = shared.select("mark", F.col("set.set_key").alias("set_key"), "set")
    wanted = shared.select("set_key").distinct().join(classes, "set_key").select("set_key", F.col("first_id").alias("doc_id"))
    segments = stored(_segments(documents, wanted, similarity).dropDuplicates(["set_key", "fragment"]), "ngram-segments")
    first_links = stored(linked_pairs(first_pairs, segments, similarity), "ngram-links")
    roots = components(first_links)

    placed = shared.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left").select("mark", "set", F.coalesce("root", "set_key").alias("root"))
    split = placed.groupBy("mark").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most").select("mark")
    apart = stored(placed.join(split, "mark"), "ngram-apart")
    one, other = apart.select("mark", F.col("set").alias("x"), F.col("root").alias("root_x")), apart.select("mark", F.col("set").alias("y"), F.col("root").alias("root_y"))
    across = one.join(other, (one["mark"] == other["mark"]) & (F.col("root_x") < F.col("root_y")) & _can_link("x", "y", similarity)).select(_pair("x", "y")).select("pair.*").distinct()
    second_links = stored(linked_pairs(across.join(first_pairs, ["a", "b"], "left_anti"), segments, similarity), "ngram-links")

    final = components(first_links.unionByName(second_links)).withColumnRenamed("node", "set_key")
    named = classes.join(final, "set_key", "left").select("set_key", "first_id", F.coalesce("root", "set_key").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = named.join(least, "root").select("set_key", "root", "component_id")
    return sets.join(ids, "set_key", "left").select("doc_id", "n_shingles", "set_key", "root", "component_id")


def keep_first(documents: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """One row of each component: that of the least doc_id, with all its columns.

    Rows without words link with nothing and stay; so do rows whose doc_id is null. Repeated rows
    are copies, of which one stays. Different texts under one doc_id are different documents.
    """
    found = stored(_placed(id_and_text(documents), similarity), "ngram-components")
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.limit(1).collect():
        return _first_by_set(documents, found, similarity)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = with_row(documents, doc_id=F.col("doc_id")).join(broadcast_if_small(gone), F.col("doc_id") == F.col("gone"), "left_anti")
    return kept.select("row.*")


def _first_by_set(documents: DataFrame, found: DataFrame, similarity: Similarity) -> DataFrame:
    """As keep_first, where an id may stand for several texts: rows are told apart by id and set."""
    rows = with_row(documents, doc_id=F.col("doc_id").cast("bigint"), text=as_bytes("text"))
    schema = StructType([*rows.schema.fields, StructField("set_key", LongType())])

    def with_key(batches: Iterable[pa.RecordBatch]):
        shingler = Shingler(similarity.words)
        for batch in grouped(batches):
            keys = pa.array([_set_key(shingler.grams(text)) for text in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=schema.names)

    named = found.filter("doc_id IS NOT NULL AND root IS NOT NULL").select("root", F.struct("doc_id", "set_key").alias("one"))
    first = named.groupBy("root").agg(F.min("one").alias("first"))
    gone = named.join(first, "root").filter("one <> first").select(F.col("one.doc_id").alias("gone"), F.col("one.set_key").alias("gone_key")).distinct()
    keyed = rows.mapInArrow(with_key, schema)
    kept = keyed.filter("doc_id IS NOT NULL").join(broadcast_if_small(gone), (F.col("doc_id") == F.col("gone")) & (F.col("set_key") == F.col("gone_key")), "left_anti")
    one_each = kept.withColumn("wordless", F.when(F.col("set_key").isNull(), F.col("text"))).dropDuplicates(["doc_id", "set_key", "wordless"])
    return one_each.select("row").unionByName(keyed.filter("doc_id IS NULL").select("row")).select("row.*")
