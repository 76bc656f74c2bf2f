"""Removal of long repeated strings, with a difference-cover sample of all suffixes.

Whether a `window`-byte string starts at two places is a question about suffixes: two suffixes have
a common prefix of that length when they are neighbours in a sorted order of such prefixes. Sorting
every suffix would ship many times the input, so the sample goes first:

1. *Sample.* A perfect difference cover modulo v picks 12 of 133 positions (for 200 bytes). For any
   two places i and j there is an offset k below v with i + k and j + k both sampled, so equal
   windows hold equal sampled tuples of `window - v + 1` bytes at such a k.
2. *Sort and name the sampled tuples.* A tuple's name is a fingerprint of its bytes. Each chunk of
   documents sends its sorted distinct names, cut by ranges; a range merges the runs, compares
   adjacent names, and answers one bit per name: repeated or not.
3. *Recurse on the names.* A suffix without a repeated sampled tuple in reach repeats nowhere; only
   the others go on, with names of the full length built from the shorter ones by doubling.
4. *Merge the remaining suffixes.* Their full names, sorted runs again, are merged by range, and
   adjacent equal prefixes of `window` bytes mark each other.

Only equality of prefixes matters here, so names are ordered as numbers, not as their bytes; the
sample, the merging and the comparison of neighbours are those of the suffix sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .batches import stored
from .hashing import mixed
from .sorted_runs import RUNS, merge_runs, names_bits, repeated_names, rows_of, sorted_runs, with_answers, written_chunks

WINDOW_BYTES = 200
#: Names that one merging task holds at a time, about.
NAMES_PER_RANGE = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 17


def difference_cover(largest: int) -> tuple[int, np.ndarray]:
    """A perfect difference set of the largest modulus q*q + q + 1 (q prime) up to `largest`.

    Singer's construction: powers of a root of a primitive cubic over the integers modulo q; those
    without a square term, taken modulo v, are the set. Below 7 every position is sampled.
    """
    primes = [q for q in range(2, 200) if all(q % d for d in range(2, q)) and q * q + q + 1 <= largest]
    if not primes:
        return 1, np.zeros(1, np.int64)
    q = primes[-1]
    v = q * q + q + 1
    for a, b, c in ((a, b, c) for a in range(q) for b in range(q) for c in range(1, q)):
        x, cover, order = (1, 0, 0), [], 0
        while order < q**3 - 1:
            if x[2] == 0:
                cover.append(order % v)
            # Multiply by the root of t^3 = a t^2 + b t + c.
            x = (c * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
            order += 1
            if x == (1, 0, 0):
                break
        found = sorted(set(cover))
        differences = {(i - j) % v for i in found for j in found}
        if len(found) == q + 1 and len(differences) == v:
            return v, np.array(found)
    raise AssertionError("a primitive cubic exists for every prime")


def prefix_names(data: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all strings of this length; names of double length come from two names."""
    with np.errstate(over="ignore"):
        names, size, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
        whole, done = None, 0
        rest = length
        while True:
            if rest & 1:
                if whole is None:
                    whole, done = names, size
                else:
                    count = len(data) - done - size + 1
                    whole = whole[:count] * power + names[done : done + count]
                    done += size
            rest >>= 1
            if not rest:
                return mixed(whole)
            count = len(data) - 2 * size + 1
            names = names[:count] * power + names[size : size + count]
            power = power * power
            size *= 2


class Chunk:
    """Documents laid end to end, and what can be asked of their positions."""

    def __init__(self, data: bytes, lengths: Iterable[int], window: int) -> None:
        self.data = np.frombuffer(data, np.uint8)
        self.lengths = np.array(list(lengths), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.window = window
        self.period, self.cover = difference_cover(window * 3 // 4)
        self.tuple = window - self.period + 1

    def _names_at(self, places: np.ndarray, length: int) -> np.ndarray:
        """Names of the strings at sorted places, computed slice by slice."""
        out = np.zeros(len(places), np.uint64)
        for start in range(0, len(self.data), _SLICE):
            low, high = np.searchsorted(places, (start, start + _SLICE))
            if low < high:
                first = int(places[low])
                last = int(places[high - 1])
                out[low:high] = prefix_names(self.data[first : last + length], length)[places[low:high] - first]
        return out

    def sampled(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places whose tuple lies in one document with a whole window, and their names.

        Of the names the first `bits` bits are kept: two tuples with one name only cost work later.
        """
        found = []
        for start, length in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            if length >= self.window:
                rounds = np.arange(0, length, self.period)
                own = (rounds[:, None] + self.cover[None, :]).ravel()
                found.append(own[own <= length - self.tuple] + start)
        places = np.concatenate(found) if found else np.zeros(0, np.int64)
        return places, self._names_at(places, self.tuple) & ~np.uint64((1 << (64 - bits)) - 1)

    def in_doubt(self, places: np.ndarray) -> np.ndarray:
        """Window starts with one of these sampled places less than a period ahead."""
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, np.maximum(places - self.period + 1, 0), 1)
        np.add.at(change, places + 1, -1)
        open_ = np.cumsum(change[:-1], dtype=np.int32) > 0
        for start, length in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            open_[max(start, start + length - self.window + 1) : start + length] = False
        return np.flatnonzero(open_)

    def windows(self, places: np.ndarray) -> np.ndarray:
        return self._names_at(places, self.window)

    def results(self, repeated: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        """Per document: bytes, removed bytes, removed runs, kept bytes; `repeated` are window starts."""
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + self.window, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        for start, length in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            own = gone[start : start + length]
            removed = int(own.sum())
            spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
            yield length, removed, spans, self.data[start : start + length][~own].tobytes()


_RESULT = StructType(
    [StructField("doc_id", LongType()), StructField("n_bytes", LongType(), False), StructField("n_removed", LongType(), False), StructField("n_spans", LongType(), False), StructField("kept_sha256", StringType(), False), StructField("kept", BinaryType(), False)]
)


def remove_repeats(documents: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """Per row of (doc_id, binary text): the text without the bytes of strings that start elsewhere too.

    Gives n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept (the bytes).
    Matches lie within documents; the same document may hold both. Null texts count as empty; texts
    shorter than the window keep all. Repeated rows are copies of each other and lose all that lies
    in a window. Other columns are not carried.
    """
    chunks, total = written_chunks(documents)
    period, cover = difference_cover(window * 3 // 4)
    sampled = total * len(cover) / period
    sample_parts = int(sampled / NAMES_PER_RANGE) + 1
    bits = names_bits(sampled)

    def sample(batches: Iterable[pa.RecordBatch]):
        for row in rows_of(batches):
            _, names = Chunk(row["data"], row["lengths"], window).sampled(bits)
            yield sorted_runs(row["chunk"], names, sample_parts)

    repeated_tuples = stored(merge_runs(chunks.mapInArrow(sample, RUNS), sample_parts), "repeats")
    # Within a repeated stretch all its sampled tuples are repeated; at its ends one opens a whole period.
    opened = min(total, (repeated_tuples.agg(F.sum("n")).first()[0] or 0) * period / len(cover) * 2)
    window_parts = int(opened / NAMES_PER_RANGE) + 1

    def doubtful(row: dict) -> tuple[Chunk, np.ndarray, np.ndarray]:
        chunk = Chunk(row["data"], row["lengths"], window)
        places, names = chunk.sampled(bits)
        open_ = chunk.in_doubt(places[repeated_names(row["answers_0"], names, sample_parts)])
        return chunk, open_, chunk.windows(open_)

    def full(batches: Iterable[pa.RecordBatch]):
        for row in rows_of(batches):
            yield sorted_runs(row["chunk"], doubtful(row)[2], window_parts)

    repeated_windows = stored(merge_runs(with_answers(chunks, total, repeated_tuples).mapInArrow(full, RUNS), window_parts), "repeats")

    def finish(batches: Iterable[pa.RecordBatch]):
        for row in rows_of(batches):
            chunk, open_, names = doubtful(row)
            rows = list(chunk.results(open_[repeated_names(row["answers_1"], names, window_parts)]))
            sizes, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
            hashes = [hashlib.sha256(k).hexdigest() for k in kept]
            columns = [pa.array(row["doc_ids"], pa.int64()), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(hashes, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=_RESULT.names)

    return with_answers(chunks, total, repeated_tuples, repeated_windows).mapInArrow(finish, _RESULT)
