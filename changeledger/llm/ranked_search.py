"""Ranked lexical search: exact inner-product search over ball trees of sparse document vectors.

A document is a vector of saturated term frequencies, an item a vector of term weights; both are whole
numbers, and the score is their inner product. Only terms of items matter, so documents are projected
on them. Tasks build ball trees over their documents: a node has a centroid and radii, which bound the
score of every document below it. Each item descends best-first, skips subtrees whose bound is below
its k-th score so far, and scores the documents of a leaf in 64-bit integers. Bounds are computed in
doubles and rounded up by more than their error; they only decide what is skipped, never a score.

Three radii are kept, and the least bound counts: of one ball over all terms, of balls over groups of
terms that items share, and of every single term. The first alone hardly ever rules out a subtree.

Null texts and texts without a term match nothing. Rows with one doc_id are documents of their own, as
are items with one item_id. A null doc_id goes before all others among equal scores. Texts are read
whole; an item may be as long as a document.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import grouped, stored

#: Items searched in one pass over the documents, and the bytes of their texts (one longer item alone).
ITEMS_PER_PASS, ITEM_BYTES = 4000, 4 << 20

#: Documents of one task; each task returns at most k of them per item.
DOCS_PER_TASK = 1 << 14

#: Cells of a tree's document matrix: bounds the memory whatever the number of terms.
TREE_CELLS = 24 << 20

LEAF_DOCS, CHILDREN = 32, 16

#: Terms in more than this share of the documents have a radius of their own only.
COMMON = 0.02

#: Columns of the hashed vectors by which documents are split into halves.
SKETCH_COLUMNS = 32

#: Relative slack of bounds; sums of a million terms err by less than a tenth of it.
SLACK = 1e-8

#: Bytes of terms, A-Z in lower case; every other byte below 128 parts terms.
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_NO_ID = np.iinfo(np.int64).min


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, with only A-Z in lower case."""
    return [] if text is None else text.translate(_TO_TERMS).split()


@dataclass(frozen=True)
class Corpus:
    """What scores need of all documents: their number, terms, and documents per term id."""

    n_docs: int
    n_terms: int
    doc_frequencies: dict[int, int]

    def weight(self, term: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * self.doc_frequencies.get(term, 0) + 1)))

    def length_measure(self, n: int) -> int:
        return 100 - 25 + (25 * n * self.n_docs) // self.n_terms


def saturated(tf: np.ndarray, measure: np.ndarray) -> np.ndarray:
    """Value of a term in a document, at most a million."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * measure)


def _projected(vocabulary: dict[bytes, int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches):
            ids, lengths, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if words:
                    held = [(vocabulary[word], count) for word, count in Counter(words).items() if word in vocabulary]
                    ids.append(doc_id)
                    lengths.append(len(words))
                    terms.append([term for term, _ in held])
                    counts.append([count for _, count in held])
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["doc_id", "n_terms", "terms", "counts"])

    return project


@dataclass(frozen=True)
class Item:
    """Terms of an item in the order of their groups, with weights times repeats."""

    number: int
    terms: np.ndarray
    weights: np.ndarray  # whole numbers
    group_starts: np.ndarray
    groups: np.ndarray
    group_norms: np.ndarray
    norm: float


def _term_groups(items: list[list[int]], corpus: Corpus, n_vocabulary: int) -> np.ndarray:
    """A group per term: rare terms that first occur in one item together, common terms alone."""
    groups = np.full(n_vocabulary, -1)
    n_groups = 0
    for terms in items:
        fresh = [term for term in dict.fromkeys(terms) if groups[term] < 0]
        rare = [term for term in fresh if corpus.doc_frequencies.get(term, 0) <= COMMON * corpus.n_docs]
        for term in set(fresh) - set(rare):
            groups[term] = n_groups
            n_groups += 1
        groups[rare] = n_groups
        n_groups += bool(rare)
    return groups


def _weighted(number: int, terms: list[int], corpus: Corpus, groups: np.ndarray) -> Item | None:
    """The item's vector; None if no document has any of its terms with a weight."""
    repeats = {term: count * corpus.weight(term) for term, count in Counter(terms).items() if corpus.doc_frequencies.get(term)}
    held = sorted((groups[term], term, weight) for term, weight in repeats.items() if weight > 0)
    if not held:
        return None
    group_of, term_ids, weights = (np.array(column, np.int64) for column in zip(*held, strict=True))
    starts = np.flatnonzero(np.r_[True, group_of[1:] != group_of[:-1]])
    squares = weights.astype(np.float64) ** 2
    return Item(number, term_ids, weights, starts, group_of[starts], np.sqrt(np.add.reduceat(squares, starts)), math.sqrt(squares.sum()))


def _halved(sketch: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows in leaf order: each half is nearer to one of two documents far apart; halves are equal."""
    if len(rows) <= LEAF_DOCS:
        return rows
    points = sketch[rows]
    one = points[np.argmax(((points - points.mean(axis=0)) ** 2).sum(axis=1))]
    other = points[np.argmax(((points - one) ** 2).sum(axis=1))]
    order = np.argsort(points @ (other - one), kind="stable")
    leaves = -(-len(rows) // LEAF_DOCS)
    cut = leaves // 2 * LEAF_DOCS
    return np.concatenate([_halved(sketch, rows[order[:cut]]), _halved(sketch, rows[order[cut:]])])


class BallTree:
    """Documents in leaf order, and for each node the centroid and radii of its run of documents."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, sketch: np.ndarray, groups: np.ndarray) -> None:
        order = _halved(sketch, np.arange(len(ids)))
        self.ids, self.values = ids[order], values[order]
        self.bounds: list[tuple[int, int]] = []  # run of documents of each node
        self.children: list[range] = []
        runs = [(start, min(start + LEAF_DOCS, len(ids))) for start in range(0, len(ids), LEAF_DOCS)]
        below = [range(0)] * len(runs)
        while True:
            first = len(self.bounds)
            self.bounds += runs
            self.children += below
            if len(runs) == 1:
                break
            parts = range(0, len(runs), CHILDREN)
            below = [range(first + part, first + min(part + CHILDREN, len(runs))) for part in parts]
            runs = [(runs[part][0], runs[min(part + CHILDREN, len(runs)) - 1][1]) for part in parts]
        self.by_group = np.argsort(groups, kind="stable")
        self.group_starts = np.flatnonzero(np.r_[True, np.diff(groups[self.by_group]) != 0])
        n_nodes, n_terms = len(self.bounds), values.shape[1]
        self.centroids, self.spreads = np.empty((n_nodes, n_terms)), np.empty((n_nodes, n_terms))
        self.radii, self.ball = np.empty((n_nodes, len(self.group_starts))), np.empty(n_nodes)
        for node, (start, end) in enumerate(self.bounds):
            self._measure(node, self.values[start:end])

    def _measure(self, node: int, documents: np.ndarray) -> None:
        centroid = documents.mean(axis=0)
        self.centroids[node] = centroid
        self.spreads[node] = documents.max(axis=0) - centroid
        in_groups, in_all = np.zeros(len(self.group_starts)), 0.0
        for start in range(0, len(documents), LEAF_DOCS):
            away = (documents[start : start + LEAF_DOCS] - centroid)[:, self.by_group] ** 2
            squares = np.add.reduceat(away, self.group_starts, axis=1)
            in_groups = np.maximum(in_groups, squares.max(axis=0))
            in_all = max(in_all, squares.sum(axis=1).max())
        self.radii[node] = np.sqrt(in_groups)
        self.ball[node] = math.sqrt(in_all)

    def upper_bounds(self, item: Item, nodes: range) -> np.ndarray:
        """No document below these nodes scores higher."""
        run = slice(nodes.start, nodes.stop)
        at_centroid = self.centroids[run, item.terms] @ item.weights
        by_term = np.add.reduceat(self.spreads[run, item.terms] * item.weights, item.group_starts, axis=1)
        by_group = self.radii[run, item.groups] * item.group_norms
        beyond = np.minimum(np.minimum(by_term, by_group).sum(axis=1), self.ball[run] * item.norm)
        return (at_centroid + beyond) * (1 + SLACK) + 1

    def search(self, item: Item, best: Best) -> int:
        """Offer every document that may be among the best; returns the number of leaves scored."""
        scored, root = 0, len(self.bounds) - 1
        waiting = [(-math.inf, root)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < best.least:
                break
            if children := self.children[node]:
                bounds = self.upper_bounds(item, children)
                for child in np.flatnonzero(bounds >= best.least):
                    heapq.heappush(waiting, (-bounds[child], children[child]))
            else:
                start, end = self.bounds[node]
                best.offer(self.values[start:end, item.terms].astype(np.int64) @ item.weights, self.ids[start:end])
                scored += 1
        return scored


class Best:
    """The k highest scores so far, equal ones by id; documents below `least` cannot enter."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        may_enter = scores >= self.least
        if not may_enter.any():
            return
        scores, ids = np.r_[self.scores, scores[may_enter]], np.r_[self.ids, ids[may_enter]]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def _trees(batches: Iterable[pa.RecordBatch], corpus: Corpus, groups: np.ndarray) -> Iterator[BallTree]:
    """Ball trees over the documents of a task, each within TREE_CELLS."""
    n_terms = len(groups)
    per_tree = min(DOCS_PER_TASK, max(LEAF_DOCS, TREE_CELLS // n_terms))
    weights = np.array([corpus.weight(term) for term in range(n_terms)], np.float64)
    signs = np.where(np.arange(n_terms) * 2654435761 >> 7 & 1, 1.0, -1.0) * weights
    columns = np.arange(n_terms) * 40503 % SKETCH_COLUMNS

    def tree(held: list[pa.RecordBatch]) -> BallTree:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = np.array(table.column("doc_id").fill_null(int(_NO_ID)), np.int64)
        lengths = table.column("terms").combine_chunks().value_lengths().to_numpy()
        terms = table.column("terms").combine_chunks().flatten().to_numpy()
        counts = table.column("counts").combine_chunks().flatten().to_numpy()
        measures = np.array([corpus.length_measure(n) for n in table.column("n_terms").to_pylist()], np.int64)
        rows = np.repeat(np.arange(len(ids)), lengths)
        found = saturated(counts, measures[rows])
        values = np.zeros((len(ids), n_terms), np.int32)
        values[rows, terms] = found
        cells = rows * SKETCH_COLUMNS + columns[terms]
        sketch = np.bincount(cells, found * signs[terms], len(ids) * SKETCH_COLUMNS).reshape(len(ids), SKETCH_COLUMNS)
        return BallTree(ids, values, sketch, groups)

    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, per_tree):
            part = batch.slice(start, per_tree)
            if size + part.num_rows > per_tree:
                yield tree(held)
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if held:
        yield tree(held)


def _searched(items: list[Item], corpus: Corpus, groups: np.ndarray, k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for tree in _trees((batch for batch in batches if batch.num_rows), corpus, groups):
            for item, so_far in zip(items, best, strict=True):
                tree.search(item, so_far)
        for item, found in zip(items, best, strict=True):
            if len(found.ids):
                columns = [
                    pa.array(np.full(len(found.ids), item.number)), pa.array(found.ids, mask=found.ids == _NO_ID), pa.array(found.scores),
                ]
                yield pa.record_batch(columns, names=["item", "doc_id", "score"])

    return search


def _search_pass(documents: DataFrame, item_terms: list[list[bytes]], k: int) -> DataFrame | None:
    """(`item`, `doc_id`, `score`): candidates of every task for the items, numbered from 0."""
    vocabulary = {term: number for number, term in enumerate(dict.fromkeys(term for terms in item_terms for term in terms))}
    projected = stored(documents.mapInArrow(_projected(vocabulary), "doc_id bigint, n_terms bigint, terms array<int>, counts array<bigint>"), "search-vectors")
    totals = projected.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_terms").alias("terms"), F.count_if(F.size("terms") > 0).alias("matching")).first()
    if not totals["matching"]:
        return None
    counted = projected.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    corpus = Corpus(totals["docs"], totals["terms"], {row["term"]: row["docs"] for row in counted.collect()})
    numbers = [[vocabulary[term] for term in terms] for terms in item_terms]
    groups = _term_groups(numbers, corpus, len(vocabulary))
    items = [item for number, terms in enumerate(numbers) if (item := _weighted(number, terms, corpus, groups))]
    # Tasks of equal size, however the files are cut: the candidates returned grow with the tasks.
    matching = projected.where(F.size("terms") > 0).repartition(-(-totals["matching"] // DOCS_PER_TASK))
    return matching.mapInArrow(_searched(items, corpus, groups, k), "item bigint, doc_id bigint, score bigint")


def _passes(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items (`item_id`, terms) in blocks of bounded number and bytes; the driver holds one block."""
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        length = len(text or b"")
        if block and (len(block) == ITEMS_PER_PASS or size + length > ITEM_BYTES):
            yield block
            block, size = [], 0
        block.append((item_id, terms_of(None if text is None else bytes(text))))
        size += length
    if block:
        yield block


def ranked(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The k best documents (`doc_id`, binary `text`) for each item (`item_id`, binary `text`).

    Returns (`item_id`, `rank`, `doc_id`, `score`), with scores above 0 only. A pass takes a block of
    items, whose terms and vectors travel with the job, over all documents.
    """
    found = []
    for block in _passes(items):
        candidates = _search_pass(documents, [terms for _, terms in block], k)
        if candidates is not None:
            best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
            top = candidates.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
            names = documents.sparkSession.createDataFrame([(number, item_id) for number, (item_id, _) in enumerate(block)], "item bigint, item_id bigint")
            found.append(stored(top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-results"))
    if not found:
        return documents.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result
