"""Toxicity from the nearest labelled examples.

Texts are TF-IDF vectors over the words and beginnings of words that labels single out, and one term
that every word counts for, so that what is rare in a text weighs little. The examples are the documents of an
inverted index with block maxima; for a text the blocks are visited in the order of their bounds
until no bound reaches the k-th similarity, so the nearest examples by cosine are exact. They vote
with weights that fall with the distance, and isotonic regression on votes about the examples
themselves, each left out in turn, makes the votes probabilities. The nearest examples are the
evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .batches import decoded, stored
from .calibration import Isotonic, fit_isotonic

_WORDS = re.compile(r"[^\W\d_]+")
_BLOCK = 64


@dataclass(frozen=True)
class Settings:
    """What is learned from: examples of each class, and neighbours that vote.

    Every term that is in `support` examples and differs between the classes by `chi_square` is
    taken, however many there are. Beginnings have the given numbers of letters.
    """

    examples_per_class: int = 1500
    support: int = 3
    chi_square: float = 15.0
    neighbours: int = 15
    beginnings: tuple[int, ...] = (3, 4, 5, 6, 7, 8)


def features(word: str, beginnings: tuple[int, ...]) -> list[str]:
    """The word itself, and its beginnings marked by a star."""
    return [word, *(word[:size] + "*" for size in beginnings if size < len(word))]


@dataclass
class ExampleIndex:
    """Inverted index of unit vectors, in blocks of examples with the largest value of each term.

    The lists of a block are the rows of one small array, for the terms that its examples have.
    """

    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    block_max: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    @staticmethod
    def build(examples: list[tuple[int, int, float, np.ndarray, np.ndarray]], terms: int) -> ExampleIndex:
        """From (id, label, weight of its class, term numbers, unit vector). Alike examples share blocks."""
        examples = sorted((e for e in examples if len(e[3])), key=lambda e: (e[1], e[3].tolist(), e[0]))
        index = ExampleIndex(np.array([e[0] for e in examples], np.int64), np.array([e[1] for e in examples]), np.array([e[2] for e in examples]))
        for start in range(0, len(examples), _BLOCK):
            some = examples[start : start + _BLOCK]
            own = np.unique(np.concatenate([example[3] for example in some]))
            block = np.zeros((len(own), _BLOCK))
            for column, example in enumerate(some):
                block[np.searchsorted(own, example[3]), column] = example[4]
            index.blocks.append((own, block))
        index.block_max = np.zeros((terms, len(index.blocks)))
        for number, (own, block) in enumerate(index.blocks):
            index.block_max[own, number] = block.max(axis=1)
        return index

    def nearest(self, terms: np.ndarray, values: np.ndarray, count: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the nearest examples, nearest first, ties to the smaller id.

        Only examples that share a term count. `skip` is the id of an example to leave out.
        """
        if not len(terms) or not len(self.ids):
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = values @ self.block_max[terms]
        found, similar = np.zeros(0, np.int64), np.zeros(0)
        for block in np.argsort(-bounds, kind="stable").tolist():
            if bounds[block] <= 0 or (len(found) == count and bounds[block] < similar[-1] - 1e-12):
                break
            own, lists = self.blocks[block]
            at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
            there = own[at] == terms
            sums = values[there] @ lists[at[there]]
            hit = np.flatnonzero(sums > 0)
            numbers = hit + block * _BLOCK
            if skip is not None:
                other = self.ids[numbers] != skip
                hit, numbers = hit[other], numbers[other]
            if len(found) == count and sums.max() < similar[-1] - 1e-12:
                continue
            found, similar = np.concatenate([found, numbers]), np.concatenate([similar, sums[hit]])
            order = np.lexsort((self.ids[found], -np.round(similar, 12)))[:count]
            found, similar = found[order], similar[order]
        return found, similar


@dataclass
class Toxicity:
    """What is learned; `blank` is the probability of a text without any of the terms.

    Number 0 is the term of all words.
    """

    terms: dict[str, int]
    idf: np.ndarray
    index: ExampleIndex
    neighbours: int
    blank: float
    calibrated: Isotonic
    beginnings: tuple[int, ...] = ()
    _known: dict[str, list[int]] = field(default_factory=dict)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), np.int64)
        values = np.array([1 + np.log(counts[t]) for t in terms.tolist()]) * self.idf[terms] if len(terms) else np.zeros(0)
        return terms, values / np.linalg.norm(values) if len(values) else values

    def count_terms(self, text: str | None) -> dict[int, int]:
        """The terms that the text has and how often; none if it has only words that tell nothing."""
        words = _WORDS.findall(text.lower()) if text else []
        counts: Counter = Counter()
        known = self._known
        if len(known) > 500_000:
            known.clear()
        for word in words:
            own = known.get(word)
            if own is None:
                own = known[word] = [self.terms[f] for f in features(word, self.beginnings) if f in self.terms]
            if own:
                counts.update(own)
        if counts:
            counts[0] = len(words)
        return counts

    def vote(self, counts: dict[int, int], skip: int | None = None) -> tuple[float | None, list[int]]:
        """The share of toxic votes and the ids of the voters; null without a neighbour."""
        numbers, similar = self.index.nearest(*self.vector(counts), self.neighbours, skip)
        if not len(numbers):
            return None, []
        weights = self.index.weights[numbers] / (1.05 - np.minimum(similar, 1))
        return float((weights * self.index.labels[numbers]).sum() / weights.sum()), self.index.ids[numbers].tolist()


def _examples(documents: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, dict[int, float]]:
    """(doc_id, label, text) and (doc_id, label, words) of the examples; what one of each class stands for."""
    labelled = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    totals = {row["label"]: row["n"] for row in labelled.groupBy("label").agg(F.count("*").alias("n")).filter("label IN (0, 1)").collect()}
    chosen = None
    for label in (0, 1):
        own = labelled.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.examples_per_class)
        chosen = own if chosen is None else chosen.unionByName(own)
    schema = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("words", ArrayType(StringType()))])

    def count(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            both = [{f for w in _WORDS.findall((text or "").lower()) for f in features(w, settings.beginnings)} for text in decoded(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array([list(c) for c in both], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    # The chosen ids are bounded by the settings.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    texts = stored(texts, "toxicity-examples")
    got = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return texts, texts.mapInArrow(count, schema), {label: totals[label] / got[label] for label in got}


def _telling_words(examples: DataFrame, settings: Settings) -> list[str]:
    """Words whose share of examples differs most between the classes."""
    n1, n0 = examples.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not n1 or not n0:
        return []
    per_word = examples.select("label", F.explode("words").alias("word")).groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    both, total = a + b, float(n1 + n0)
    chi_square = total * F.pow(a * (n0 - b) - b * (n1 - a), 2) / (both * (total - both) * float(n1) * float(n0))
    ranked = per_word.filter((both >= settings.support) & (both < total)).withColumn("chi", chi_square).filter(F.col("chi") >= settings.chi_square)
    return [row["word"] for row in ranked.orderBy(F.desc("chi"), "word").collect()]


def _documents_with(documents: DataFrame, model: Toxicity) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those that have each term; all have the first."""
    schema = StructType([StructField("term", IntegerType()), StructField("n", LongType())])

    def count(batches: Iterable[pa.RecordBatch]):
        seen: Counter = Counter()
        for batch in batches:
            seen[-1] += batch.num_rows
            for text in decoded(batch.column("text")):
                seen.update(model.count_terms(text).keys())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=schema.names)

    rows = documents.select("text").mapInArrow(count, schema).groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {row["term"]: row["n"] for row in rows}
    total = found.get(-1, 0)
    return total, np.array([total, *(found.get(t, 0) for t in range(1, len(model.idf)))])


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Toxicity:
    """Learn from (doc_id, binary text) and (doc_id, label 0 or 1); null labels teach nothing.

    Of several labels of a document the largest counts. Examples are at most `examples_per_class` of
    each class, chosen by a hash of the id, and stand for all of their class; of several texts under
    one id the least in byte order is the example. Word statistics are those of all documents. With one class only, every text gets that class's share.
    """
    texts, examples, stands_for = _examples(documents, labels, settings)
    words = _telling_words(examples, settings)
    size = len(words) + 1
    empty = Isotonic(np.zeros(0), np.zeros(0))
    model = Toxicity({w: i + 1 for i, w in enumerate(words)}, np.ones(size), ExampleIndex.build([], size), settings.neighbours, 0.0, empty, settings.beginnings)
    total, having = _documents_with(documents, model)
    model.idf = np.log((1 + total) / (1 + having)) + 1
    schema = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("terms", ArrayType(IntegerType())), StructField("counts", ArrayType(IntegerType()))])

    def pick(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows = [model.count_terms(text) for text in decoded(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array([list(r) for r in rows], pa.list_(pa.int32())), pa.array([list(r.values()) for r in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    picked = texts.mapInArrow(pick, schema)
    rows = sorted((row["doc_id"], row["label"], dict(zip(row["terms"], row["counts"], strict=True))) for row in picked.collect())
    model.index = ExampleIndex.build([(doc_id, label, stands_for[label], *model.vector(counts or {0: 1})) for doc_id, label, counts in rows], size)
    blank = [(label, stands_for[label]) for _, label, counts in rows if not counts]
    blank = blank or [(label, stands_for[label]) for _, label, _ in rows]
    model.blank = sum(label * w for label, w in blank) / sum(w for _, w in blank) if blank else 0.0
    votes = [(vote, stands_for[label], label) for doc_id, label, counts in rows if counts for vote in [model.vote(counts, doc_id)[0]] if vote is not None]
    if votes:
        x, weight, label = (np.array(column, float) for column in zip(*votes, strict=True))
        model.calibrated = fit_isotonic(np.round(x, 6), weight, weight * label)
    return model


def predict(documents: DataFrame, model: Toxicity) -> DataFrame:
    """Per row of (doc_id, binary text): score and evidence, the ids of the examples that voted.

    A text without any telling term, null and empty texts included, has the share of toxic texts
    among such examples and no evidence. Repeated rows are scored each by itself.
    """
    schema = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType(), False), StructField("evidence", ArrayType(LongType(), False), False)])

    def score(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            votes = [model.vote(model.count_terms(text)) for text in decoded(batch.column("text"))]
            known = model.calibrated(np.round(np.array([v if v is not None else 0.0 for v, _ in votes]), 6))
            scores = [model.blank if v is None else float(k) for (v, _), k in zip(votes, known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([ids for _, ids in votes], pa.list_(pa.int64()))], names=schema.names)

    return documents.select("doc_id", "text").mapInArrow(score, schema)
