"""Language by unigrams of a fixed piece vocabulary, summed over all segmentations.

Each language has a probability for every piece. The probability of a word is the sum, over all its
segmentations into pieces, of the product of the pieces' probabilities; the forward algorithm sums
them without listing them, once per node of the trie of distinct words and for all languages
together; words too long for the trie are summed one byte after the other, all of them at once. A
text's score is the posterior of its best language, the languages being equally likely beforehand.
Many languages are learned and scored in groups, one after the other.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from changeledger.operators.broadcasting import broadcast_if_small

from .batches import GROUP_BYTES, as_bytes, decoded, grouped, stored, with_row
from .bpe import load_encoding, load_ranks
from .pieces import TRIE_BYTES, Pieces, matches, over_trie

UNKNOWN = "und"
#: Expected number of learning documents of a language, taken by a hash of the id.
DOCUMENTS_PER_LANGUAGE = 2000
#: Languages that are learned and scored at once: what a task holds is bounded, the number of languages is not.
LANGUAGES_PER_GROUP = 400
#: Words over TRIE_BYTES that are summed at once, and about how many of their bytes.
_LONG_WORDS = 512
_LONG_BYTES = 1 << 16
#: Log-probabilities that differ by less are equal: sums of the same terms differ by rounding.
_EQUAL = 1e-9

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; none if the text has no letter."""
    words = _WORDS.findall(text.lower()) if text else []
    return words if any(c.isalpha() for w in words for c in w) else []


def learning_sample(labelled: DataFrame, per_language: int = DOCUMENTS_PER_LANGUAGE) -> DataFrame:
    """About `per_language` rows of each language of (doc_id, text, lang), chosen by a hash of the id."""
    totals = stored(labelled.groupBy("lang").agg(F.count("*").alias("n")), "language-totals")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    return labelled.select("doc_id", "text", "lang").join(broadcast_if_small(totals), "lang").filter(drawn < F.floor(F.lit((1 << 20) * per_language) / F.col("n"))).drop("n")


def piece_counts(labelled: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """How often each piece stands for the words of each language: (lang, piece, n)."""
    schema = StructType([StructField("lang", StringType()), StructField("piece", IntegerType()), StructField("n", LongType())])

    def count(batches: Iterable[pa.RecordBatch]):
        encoding = load_encoding(ranks_path, pattern)
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), decoded(batch.column("text")), strict=True):
                seen[lang].update(words_of(text))
        for lang, words in seen.items():
            pieces: Counter = Counter()
            for word, n in words.items():
                for piece in encoding.encode_ordinary(" " + word):
                    pieces[piece] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(pieces), pa.string()), pa.array(list(pieces), pa.int32()), pa.array(list(pieces.values()), pa.int64())],
                names=["lang", "piece", "n"],
            )

    return labelled.select("lang", "text").mapInArrow(count, schema).groupBy("lang", "piece").agg(F.sum("n").alias("n"))


#: Bytes of rows that are scored together where whole rows pass: workers keep what they once held.
KEPT_GROUP_BYTES = 2 << 20


@dataclass
class LanguageModel:
    """Probabilities of the pieces, one column per language in alphabetical order."""

    languages: list[str]
    probabilities: np.ndarray


@dataclass
class Learned:
    """Counts (lang, piece, n) in the shared folder, from which models of a group of languages are made.

    `common` is each piece's share in all languages together.
    """

    counts: DataFrame
    common: np.ndarray
    smoothing: float
    per_group: int = LANGUAGES_PER_GROUP

    def models(self) -> Iterator[tuple[LanguageModel, bool]]:
        """Models of all languages in alphabetical groups, and whether it is the last; one without languages if none is known.

        What reaches the driver is at most the vocabulary times the languages of one group.
        """
        rest, last = self.counts, False
        while not last:
            names = [row["lang"] for row in rest.select("lang").distinct().orderBy("lang").limit(self.per_group + 1).collect()]
            last = len(names) <= self.per_group
            names = names[: self.per_group]
            yield self._model(names), last
            if not last:
                rest = self.counts.filter(F.col("lang") > names[-1])

    def _model(self, languages: list[str]) -> LanguageModel:
        size = len(self.common)
        seen = np.zeros((size, len(languages)))
        if languages:
            column = {lang: i for i, lang in enumerate(languages)}
            for row in self.counts.filter(F.col("lang").between(languages[0], languages[-1])).collect():
                seen[row["piece"], column[row["lang"]]] = row["n"]
            seen += (self.smoothing * size * self.common + self.smoothing)[:, None]
        return LanguageModel(languages, seen / seen.sum(axis=0, keepdims=True))


def fit(labelled: DataFrame, ranks_path: str, pattern: str, smoothing: float = 0.5, per_group: int = LANGUAGES_PER_GROUP) -> Learned:
    """Learn from rows of (doc_id, text, lang); rows without a language teach nothing.

    Every piece gets `smoothing` times its share in all languages together, and at least a uniform
    share, on top of what is seen. Any number of languages is learned, `per_group` of them at once.
    """
    counts = stored(piece_counts(learning_sample(labelled.filter(F.col("lang").isNotNull())), ranks_path, pattern), "language-pieces")
    common = np.ones(max(load_ranks(ranks_path).values()) + 1)
    for row in counts.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        common[row["piece"]] += row["n"]
    return Learned(counts, common / common.sum(), smoothing, per_group)


class Scorer:
    """Log-probabilities of words in every language."""

    def __init__(self, model: LanguageModel, ranks: dict[bytes, int]) -> None:
        self.pieces = Pieces(ranks)
        # No product over TRIE_BYTES pieces leaves the range of a double.
        self.probabilities = np.maximum(model.probabilities, 1e-6)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """One row per word: the log of the sum over all segmentations, however long the word is.

        Pieces of more than TRIE_BYTES bytes take no part.
        """
        data = [b" " + word.encode("utf-8", "replace") for word in words]
        short = [i for i, word in enumerate(data) if len(word) <= TRIE_BYTES]
        long = sorted((i for i, word in enumerate(data) if len(word) > TRIE_BYTES), key=lambda i: -len(data[i]))
        languages = self.probabilities.shape[1]
        out = np.zeros((len(words), languages))
        forward = over_trie([data[i] for i in short], self.pieces, np.ones((1, languages)), self._step, lambda n: np.zeros((n, languages)))
        out[short] = np.log(np.maximum(forward, 1e-300))
        for start in range(0, len(long), _LONG_WORDS):
            some = long[start : start + _LONG_WORDS]
            out[some] = self._over_long([data[i] for i in some])
        return out

    def _over_long(self, words: list[bytes]) -> np.ndarray:
        """The same for long words, the longest first, all of them byte by byte together.

        The sums at the last bytes are kept in a ring, as multiples of a scale that follows the newest.
        """
        lengths = np.array([len(word) for word in words])
        reach = self.pieces.lengths[-1]
        ring = np.zeros((reach + 1, len(words), self.probabilities.shape[1]))
        ring[0] = 1
        scale = np.zeros(ring.shape[1:])
        out = np.zeros(ring.shape[1:])
        start = 0
        while start < lengths[0]:
            active = int((lengths > start).sum())
            stop = min(int(lengths[0]), start + max(64, _LONG_BYTES // active))
            ends, owners, sizes, numbers = matches(words[:active], self.pieces, start, stop)
            bounds = np.searchsorted(ends, np.arange(start + 1, stop + 2))
            for end, low, high in zip(range(start + 1, stop + 1), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                newest = ring[end % (reach + 1)]
                newest[:] = 0
                owner = owners[low:high]
                if high > low:
                    parts = ring[(end - sizes[low:high]) % (reach + 1), owner] * self.probabilities[numbers[low:high]]
                    heads = np.flatnonzero(np.diff(owner, prepend=-1))
                    newest[owner[heads]] = np.add.reduceat(parts, heads)
                done = np.flatnonzero(lengths[:active] == end)
                out[done] = scale[done] + np.log(np.maximum(newest[done], 1e-300))
                if end % 4 == 0:
                    factor = np.where(newest > 1e-100, newest, 1.0)
                    ring /= factor
                    scale += np.log(factor)
            start = stop
        return out

    def _step(self, values: np.ndarray, at: np.ndarray, before: np.ndarray, numbers: np.ndarray) -> None:
        values[at] += before * self.probabilities[numbers]


def evidence(texts: list[str | None], model: LanguageModel, scorer: Scorer) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Best language of each text, its log-probability, and the log of the sum over the languages.

    Null and minus infinity without a letter or a language. Words are scored once, however many texts have them.
    """
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.int64) for text in texts]
    langs: list[str | None] = [None] * len(ids)
    top, whole = np.full(len(ids), -np.inf), np.full(len(ids), -np.inf)
    if model.languages and number:
        table = scorer.log_probabilities(list(number))
        for i, own in enumerate(ids):
            if len(own):
                total = table[own].sum(axis=0)
                best = int((total >= total.max() - _EQUAL).argmax())
                langs[i], top[i] = model.languages[best], total[best]
                whole[i] = total[best] + np.log(np.exp(total - total[best]).sum())
    return langs, top, whole


def _judged(frame: DataFrame, learned: Learned, ranks_path: str, group_bytes: int) -> DataFrame:
    """Columns lang_pred and score in place of the binary column `text`; other columns stay.

    With more languages than one group, rows pass once per group and are written in between.
    """
    kept = [c for c in frame.columns if c != "text"]
    out = frame.select(*kept, "text", F.lit(None).cast("string").alias("lang_pred"), F.lit(float("-inf")).alias("top"), F.lit(float("-inf")).alias("whole"))
    for position, (model, last) in enumerate(learned.models()):
        if position:
            out = stored(out, "language-scores")
        schema = out.drop("text").schema if last else out.schema
        out = out.mapInArrow(_pass(model, ranks_path, group_bytes, schema.names), schema)
    score = F.when(F.col("lang_pred").isNotNull(), F.exp(F.col("top") - F.col("whole"))).otherwise(0.0)
    return out.select(*kept, F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def _pass(model: LanguageModel, ranks_path: str, group_bytes: int, names: list[str]):
    """Bring the languages of one model into what earlier ones found; of equals the earlier stays."""

    def judge(batches: Iterable[pa.RecordBatch]):
        scorer = Scorer(model, load_ranks(ranks_path))
        for batch in grouped(batches, group_bytes):
            langs, top, whole = evidence(decoded(batch.column("text")), model, scorer)
            before = batch.column("top").to_numpy(zero_copy_only=False)
            better = top > before + _EQUAL
            found = {
                "lang_pred": pa.array([new if b else old for new, old, b in zip(langs, batch.column("lang_pred").to_pylist(), better.tolist(), strict=True)], pa.string()),
                "top": pa.array(np.where(better, top, before)),
                "whole": pa.array(np.logaddexp(whole, batch.column("whole").to_numpy(zero_copy_only=False))),
            }
            yield pa.RecordBatch.from_arrays([found[c] if c in found else batch.column(c) for c in names], names=names)

    return judge


def predict(documents: DataFrame, learned: Learned, ranks_path: str) -> DataFrame:
    """Per row of (doc_id, binary text): lang_pred and score.

    `und` with score 0 for texts that are null or have no letter, and for all if no language was
    learned. Of equally likely languages the first in the alphabet is taken. Repeated rows are
    scored each by itself; nothing but the text decides.
    """
    return _judged(documents.select("doc_id", "text"), learned, ranks_path, GROUP_BYTES)


def keep_clear(documents: DataFrame, learned: Learned, ranks_path: str, least_score: float, text_column: str = "text") -> DataFrame:
    """The rows whose language is known with at least this score, with all their columns."""
    found = _judged(with_row(documents, text=as_bytes(text_column)), learned, ranks_path, KEPT_GROUP_BYTES)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
