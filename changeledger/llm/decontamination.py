"""Training texts that hold items of a benchmark.

The test items are the documents of a BM25 inverted index; every passage of every training text is
a query. Impacts are divided by the score an item gets from its own words, so that one threshold
holds for all items. Retrieval is exact: lists of common words are bounded by a constant per block
of items, lists of the other words are added up as block maxima, and only blocks whose bound
reaches the threshold are scored item by item. Retrieved items count if the passage also holds
enough of the item's question and of its answer.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .batches import as_bytes, decoded, grouped, stored, with_row

#: Items whose index is held by a task at a time; more items are searched in as many passes.
ITEMS_PER_PASS = 20_000
SHINGLE_WORDS = 5
#: With so many runs for each that a changed word destroys, a share of 0.8 bears one changed word.
RUNS_PER_WORD = 5
K1, B = 1.2, 0.75
_BLOCK = 4
_CELLS = 4 << 20

_WORDS = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]\s+")


@dataclass(frozen=True)
class Thresholds:
    """Share of an item's own BM25 score to be retrieved, and shares of question and answer to count."""

    score: float = 0.6
    question: float = 0.8
    answer: float = 0.8


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item: its last line is the answer, or of a single line the last sentence.

    An item of one sentence is all question.
    """
    text = text.strip()
    cut = text.rfind("\n")
    if cut < 0:
        ends = [m.end() for m in _SENTENCE_END.finditer(text)]
        cut = ends[-1] if ends else len(text)
    question, answer = words_of(text[:cut]), words_of(text[cut:])
    return (question, answer) if question else (answer, [])


def shingles(words: list[str], size: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    """Runs of `size` words; fewer words are one run."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def contained(part: list[str], words: list[str]) -> float:
    """Share of the part's runs that the words hold; 1 for a part without words.

    One changed word destroys up to SHINGLE_WORDS runs. A part that has fewer than RUNS_PER_WORD
    times as many is also measured by shorter runs, the longest of which it has enough, or word by
    word in one stretch of its own length; the larger share counts. A part with fewer than
    RUNS_PER_WORD words is one run.
    """
    wanted = shingles(part)
    if not wanted:
        return 1.0
    share = _share_held(wanted, words)
    if share == 1.0 or len(part) < RUNS_PER_WORD or len(wanted) >= RUNS_PER_WORD * SHINGLE_WORDS:
        return share
    for size in range(SHINGLE_WORDS - 1, 1, -1):
        shorter = shingles(part, size)
        if len(shorter) >= RUNS_PER_WORD * size:
            return max(share, _share_held(shorter, words))
    return max(share, _in_one_stretch(part, words))


def _share_held(runs: set[tuple[str, ...]], words: list[str]) -> float:
    size = len(next(iter(runs)))
    return len(runs & {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}) / len(runs)


def _in_one_stretch(part: list[str], words: list[str]) -> float:
    """Most of the part's words, repeats included, in as many neighbouring words, over all of them."""
    missing = Counter(part)
    size, held, most = len(part), 0, 0
    for i, word in enumerate(words):
        if i >= size and (gone := words[i - size]) in missing:
            missing[gone] += 1
            held -= missing[gone] > 0
        if word in missing:
            held += missing[word] > 0
            missing[word] -= 1
        most = max(most, held)
    return most / size


class ItemIndex:
    """Inverted index of test items with normalised BM25 impacts and block maxima."""

    def __init__(self, items: list[tuple[int, list[str], list[str]]], frequency: dict[str, int], total: int, mean_words: float, thresholds: Thresholds) -> None:
        self.items = items
        self.thresholds = thresholds
        self.stride = max([1, *(len(q) + len(a) for _, q, a in items)])
        self.impacts: list[dict[str, float]] = []
        for _, question, answer in items:
            counts = Counter(question + answer)
            norm = K1 * (1 - B + B * sum(counts.values()) / mean_words)
            raw = {w: math.log(1 + (total - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in counts.items()}
            own = sum(raw.values())
            self.impacts.append({w: value / own for w, value in raw.items()})
        self.blocks = -(-len(items) // _BLOCK)
        self._arrange(frequency, total)

    def _arrange(self, frequency: dict[str, int], total: int) -> None:
        """Term numbers; per block the bound of common words, per other word its block maxima."""
        common = {w for own in self.impacts for w in own if frequency[w] > max(10, 0.05 * total)}
        self.rest = np.zeros(self.blocks)
        maxima: dict[str, dict[int, float]] = {}
        for i, own in enumerate(self.impacts):
            block = i // _BLOCK
            self.rest[block] = max(self.rest[block], sum(v for w, v in own.items() if w in common))
            for word, value in own.items():
                if word not in common:
                    best = maxima.setdefault(word, {})
                    best[block] = max(best.get(block, 0.0), value)
        self.number = {word: n for n, word in enumerate(maxima)}
        self.start = np.cumsum([0, *(len(m) for m in maxima.values())])
        self.block_of = np.array([b for m in maxima.values() for b in m], np.int64)
        self.block_max = np.array([v for m in maxima.values() for v in m.values()])

    def candidates(self, terms: np.ndarray, passages: np.ndarray, count: int) -> Iterator[tuple[int, int]]:
        """(passage, block) pairs whose bound reaches the threshold.

        `terms` are occurrences of indexed words (never -1), `passages` the stretch of `stride`
        words each lies in; passage p is stretch p and the next. Words that occur twice only raise
        the bound.
        """
        step = max(1, _CELLS // self.blocks)
        order_at = np.searchsorted(passages, np.arange(0, count + step, step))
        needed = self.thresholds.score - 1e-9 - self.rest
        always = np.flatnonzero(needed <= 0)
        for k, first in enumerate(range(0, count, step)):
            last = min(count, first + step)
            # One stretch more, for the last passage's second half.
            end = np.searchsorted(passages, last, side="right")
            own, stretch = terms[order_at[k] : end], passages[order_at[k] : end] - first
            lists = self.start[own + 1] - self.start[own]
            at = np.repeat(self.start[own], lists) + np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists)
            cells = np.repeat(stretch, lists) * self.blocks + self.block_of[at]
            sums = np.bincount(cells, self.block_max[at], (last - first + 1) * self.blocks).reshape(-1, self.blocks)
            bound = sums[:-1] + sums[1:]
            hit = bound >= needed
            hit[:, always] = True
            for passage, block in zip(*np.nonzero(hit), strict=True):
                yield int(passage) + first, int(block)

    def matches(self, words: list[str], block: int) -> Iterator[tuple[int, float, float, float]]:
        """Items of a block that the passage holds: (number, score, question and answer overlap)."""
        have = set(words)
        for i in range(block * _BLOCK, min(len(self.items), (block + 1) * _BLOCK)):
            own = self.impacts[i]
            score = sum(map(own.__getitem__, have & own.keys()))
            if score >= self.thresholds.score - 1e-9:
                _, question, answer = self.items[i]
                in_question, in_answer = contained(question, words), contained(answer, words)
                if in_question >= self.thresholds.question and in_answer >= self.thresholds.answer:
                    yield i, score, in_question, in_answer

    def search(self, texts: list[str | None]) -> list[dict[int, tuple[float, float, float]]]:
        """For every text the items it holds, each with its best passage's figures."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        words = [words_of(text) for text in texts]
        lookup = self.number.get
        terms, stretches, owner, first_of = [], [], [], []
        count = 0
        for d, own in enumerate(words):
            if not own:
                continue
            ids = np.array([lookup(w, -1) for w in own], np.int64)
            at = np.flatnonzero(ids >= 0)
            terms.append(ids[at])
            stretches.append(at // self.stride + count)
            first_of.append(count)
            owner.append(d)
            # An empty stretch after each text keeps its last passage to itself.
            count += (len(own) - 1) // self.stride + 2
        if not owner or not self.items:
            return found
        text_of = np.array(owner)
        first = np.array(first_of)
        for passage, block in self.candidates(np.concatenate(terms), np.concatenate(stretches), count):
            k = int(np.searchsorted(first, passage, side="right")) - 1
            d = int(text_of[k])
            at = (passage - int(first[k])) * self.stride
            for i, *figures in self.matches(words[d][at : at + 2 * self.stride], block):
                found[d][i] = max(found[d].get(i, (0.0, 0.0, 0.0)), tuple(figures))
        return found


def _indexes(items: DataFrame, thresholds: Thresholds, per_pass: int) -> Iterator[ItemIndex]:
    """One index for each pass over the texts; word statistics are those of all items."""
    schema = StructType([StructField("item_id", LongType()), StructField("question", ArrayType(StringType())), StructField("answer", ArrayType(StringType()))])

    def split(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            both = [question_and_answer(text or "") for text in decoded(batch.column("text"))]
            columns = [batch.column("item_id"), pa.array([q for q, _ in both], pa.list_(pa.string())), pa.array([a for _, a in both], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "question", "answer"])

    named = items.select(F.col("item_id").cast("bigint").alias("item_id"), as_bytes("text").alias("text"))
    parts = stored(named.mapInArrow(split, schema).filter(F.size("question") > 0), "benchmark-items")
    total, words = parts.agg(F.count("*"), F.sum(F.size("question") + F.size("answer"))).first()
    if not total:
        return
    passes = -(-total // per_pass)
    numbered = parts.withColumn("_pass", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    frequency = numbered.select(F.explode(F.array_distinct(F.concat("question", "answer"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    for number in range(passes):
        own = numbered.filter(F.col("_pass") == number)
        rows = [(row["item_id"], row["question"], row["answer"]) for row in own.collect()]
        own_words = own.select(F.explode(F.concat("question", "answer")).alias("word")).distinct()
        counts = {row["word"]: row["n"] for row in frequency.join(own_words, "word").collect()}
        yield ItemIndex(rows, counts, total, words / total, thresholds)


def contaminated(documents: DataFrame, items: DataFrame, thresholds: Thresholds = Thresholds(), per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every item a text holds.

    `documents` has (doc_id, binary text), `items` (item_id, text). Null and empty texts hold
    nothing; items without a word are never found; repeated rows are found each by itself. The
    index of one pass goes to the tasks; its size is bounded by `per_pass` items.
    """
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    schema = StructType([StructField(n, LongType() if n.endswith("_id") else DoubleType()) for n in names])
    result = None
    for index in _indexes(items, thresholds, per_pass):

        def search(batches: Iterable[pa.RecordBatch], index: ItemIndex = index):
            for batch in grouped(batches):
                found = index.search(decoded(batch.column("text")))
                rows = [(doc_id, index.items[i][0], *figures) for doc_id, own in zip(batch.column("doc_id").to_pylist(), found, strict=True) for i, figures in own.items()]
                columns = [pa.array(column, pa.int64() if k < 2 else pa.float64()) for k, column in enumerate(zip(*rows, strict=True))] if rows else []
                if columns:
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        hits = documents.select("doc_id", "text").mapInArrow(search, schema)
        result = hits if result is None else result.unionByName(hits)
    return documents.sparkSession.createDataFrame([], schema) if result is None else result


def without_contaminated(documents: DataFrame, items: DataFrame, text_column: str = "text", thresholds: Thresholds = Thresholds(), per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """The rows whose text holds no item, with all their columns; nothing is shuffled."""
    kept = with_row(documents, text=as_bytes(text_column))
    schema = kept.schema
    for index in _indexes(items, thresholds, per_pass):

        def clean(batches: Iterable[pa.RecordBatch], index: ItemIndex = index):
            for batch in grouped(batches):
                found = index.search(decoded(batch.column("text")))
                yield batch.filter(pa.array([not own for own in found]))

        kept = kept.mapInArrow(clean, schema)
    return kept.select("row.*")
