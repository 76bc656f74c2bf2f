"""Token counts under a unigram model, without writing a token.

A text is cut into pre-tokens; each is segmented into vocabulary pieces so that the sum of the
pieces' scores is highest. Score and length of the best segmentation of every prefix are computed
once per node of the trie of the distinct pre-tokens, and kept at the nodes where pre-tokens end.

The scores are learned from the corpus: its pre-tokens are segmented under a prior that falls with
the rank, and the pieces of these segmentations are counted. How often pre-tokens end at a node is
stored there, and the counts run back through the trie from the ends to the root, once per node.
Counts are integers, so that neither the order nor the grouping of rows changes a score.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .batches import decoded, grouped
from .bpe import load_ranks
from .pieces import TRIE_BYTES, Pieces, Trace, over_trie

#: Scores are integers, so that sums are exact and ties are ties: 2**20 stands for one nat.
SCORE_UNIT = 1 << 20
_WORST = -(1 << 60)
_BATCH_BYTES = 16 << 20


def piece_scores(size: int) -> np.ndarray:
    """Log-probabilities that fall with the rank as in Zipf's law, in units of 1 / SCORE_UNIT."""
    weight = 1 / np.arange(1, size + 1)
    return np.round(np.log(weight / weight.sum()) * SCORE_UNIT).astype(np.int64)


def counted_scores(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of pieces that were counted so often; each counts once more, so that none has probability 0."""
    return np.round((np.log(counts + 1) - np.log(counts.sum() + len(counts))) * SCORE_UNIT).astype(np.int64)


class TokenCounter:
    """Best score and number of pieces of pre-tokens; on a tie fewer pieces win, then the shorter last piece."""

    def __init__(self, ranks: dict[bytes, int], scores: np.ndarray | None = None) -> None:
        self.pieces = Pieces(ranks)
        self.scores = piece_scores(self.pieces.size) if scores is None else scores
        self.piece_bytes = np.zeros(self.pieces.size, np.int64)
        for piece, number in ranks.items():
            self.piece_bytes[number] = len(piece)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Rows of (score, pieces), one per word; a word without a segmentation has 0 pieces."""
        out = np.zeros((len(words), 2), np.int64)
        in_trie, others = _by_length(words)
        out[in_trie] = self._run([words[i] for i in in_trie])[:, :2]
        for i in others:
            score, pieces, _, _ = self._plain(words[i])[-1]
            out[i] = score, -pieces
        out[out[:, 0] <= _WORST // 2] = 0
        return out

    def pieces_used(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each piece is in the best segmentations of words that occur so many times."""
        used = np.zeros(self.pieces.size, np.int64)
        in_trie, others = _by_length(words)
        trace = Trace()
        self._run([words[i] for i in in_trie], trace)
        self._back(trace, times[in_trie], used)
        for i in others:
            best, end = self._plain(words[i]), len(words[i])
            while end and best[-1][0] > _WORST // 2:
                _, _, end, number = best[end]
                used[number] += times[i]
        return used

    def _run(self, words: list[bytes], trace: Trace | None = None) -> np.ndarray:
        return over_trie(words, self.pieces, np.zeros((1, 3), np.int64), self._step, _unreached, trace)

    def _step(self, values: np.ndarray, at: np.ndarray, before: np.ndarray, numbers: np.ndarray) -> None:
        score = before[:, 0] + self.scores[numbers]
        pieces = before[:, 1] + 1
        old = values[at]
        better = (score > old[:, 0]) | ((score == old[:, 0]) & (pieces < old[:, 1]))
        values[at[better]] = np.stack([score, pieces, numbers], axis=1)[better]

    def _back(self, trace: Trace, times: np.ndarray, used: np.ndarray) -> None:
        """From the deepest nodes to the root: a node's count goes to its last piece and to the node before it."""
        passing = [np.zeros(len(value), np.int64) for value in trace.values]
        for depth in range(len(trace.values) - 1, 0, -1):
            value = trace.values[depth]
            ends = trace.ends[depth]
            np.add.at(passing[depth], trace.node_of[depth][ends], times[trace.order[ends]])
            on = np.flatnonzero((passing[depth] > 0) & (value[:, 0] > _WORST // 2))
            number = value[on, 2]
            np.add.at(used, number, passing[depth][on])
            before = depth - self.piece_bytes[number]
            for level in np.unique(before).tolist():
                own = on[before == level]
                np.add.at(passing[level], trace.node_of[level][trace.heads[depth][own]], passing[depth][own])

    def _plain(self, word: bytes) -> list[tuple[int, int, int, int]]:
        """Per end: score, minus the pieces, and start and number of the last piece."""
        best = [(0, 0, 0, 0)]
        for end in range(1, len(word) + 1):
            best.append(max(((best[s][0] + int(self.scores[n]), best[s][1] - 1, s, n) for s, n in self.pieces.ending_at(word, end)), default=(_WORST, 0, 0, 0)))
        return best


def _by_length(words: list[bytes]) -> tuple[list[int], list[int]]:
    """Positions of the words that the trie takes, and of the others."""
    fits = [len(w) <= TRIE_BYTES and b"\0" not in w for w in words]
    return [i for i, fit in enumerate(fits) if fit], [i for i, fit in enumerate(fits) if not fit]


def _unreached(count: int) -> np.ndarray:
    values = np.zeros((count, 3), np.int64)
    values[:, 0] = _WORST
    return values


class _Pretokens:
    """The distinct pre-tokens of a batch; `numbers` are those of all its texts, which end at `ends`."""

    def __init__(self, texts: list[str | None], split) -> None:
        number: dict[str, int] = {}
        ids, ends = [np.zeros(0, np.int64)], [0]
        for text in texts:
            own = [number.setdefault(word, len(number)) for word in split(text)] if text else []
            ids.append(np.array(own, np.int64))
            ends.append(ends[-1] + len(own))
        self.words = [word.encode("utf-8", "replace") for word in number]
        self.numbers, self.ends = np.concatenate(ids), np.array(ends)


def learn_scores(documents: DataFrame, ranks_path: str, pattern: str, rounds: int = 1) -> np.ndarray:
    """Scores of the pieces, counted over all texts of (doc_id, text) under the prior, and again under
    the counted scores where more rounds are asked for.

    The driver gets one number per piece of the vocabulary, whatever the size of the corpus. Null and
    empty texts add nothing; repeated rows count as often as they occur; from an empty table all
    pieces are equally likely.
    """
    schema = StructType([StructField("piece", IntegerType(), False), StructField("n", LongType(), False)])
    ranks = load_ranks(ranks_path)
    size = max(ranks.values()) + 1
    scores = piece_scores(size)

    def counting(scores: np.ndarray):
        def count(batches: Iterable[pa.RecordBatch]):
            import regex

            split = regex.compile(pattern).findall
            counter = TokenCounter(load_ranks(ranks_path), scores)
            used = np.zeros(size, np.int64)
            for batch in grouped(batches, _BATCH_BYTES):
                found = _Pretokens(decoded(batch.column("text")), split)
                used += counter.pieces_used(found.words, np.bincount(found.numbers, minlength=len(found.words)))
            pieces = np.flatnonzero(used)
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), pa.array(used[pieces])], names=schema.names)

        return count

    for _ in range(rounds):
        counts = np.zeros(size, np.int64)
        for row in documents.select("doc_id", "text").mapInArrow(counting(scores), schema).groupBy("piece").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"]] = row["n"]
        scores = counted_scores(counts)
    return scores


def token_counts(documents: DataFrame, ranks_path: str, pattern: str, scores: np.ndarray | None = None) -> DataFrame:
    """Per row of (doc_id, text): pre-tokens, tokens and the score of the best segmentation.

    Null and empty texts count 0. Repeated rows are counted each by itself. `ranks_path` is a file
    on every worker; its pieces should include all bytes, since a pre-token with no segmentation
    counts no token. `scores` are those of `learn_scores`; without them the prior counts.
    """
    names = ("n_pretokens", "n_tokens", "score_units")
    schema = StructType([StructField("doc_id", LongType()), *(StructField(n, LongType(), False) for n in names)])

    def count(batches: Iterable[pa.RecordBatch]):
        import regex

        split = regex.compile(pattern).findall
        counter = TokenCounter(load_ranks(ranks_path), scores)
        for batch in grouped(batches, _BATCH_BYTES):
            found = _Pretokens(decoded(batch.column("text")), split)
            sums = np.zeros((len(found.numbers) + 1, 2), np.int64)
            np.cumsum(counter.counts(found.words)[found.numbers], axis=0, out=sums[1:])
            totals = np.diff(sums[found.ends], axis=0)
            columns = [batch.column("doc_id"), pa.array(np.diff(found.ends), pa.int64()), pa.array(totals[:, 1]), pa.array(totals[:, 0])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    return documents.select("doc_id", "text").mapInArrow(count, schema)
