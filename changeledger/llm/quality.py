"""Text quality: ridge regression on random Fourier features of document statistics.

Cosines of random projections approximate a Gaussian kernel over the standardised statistics. Every
partition sums its normal equations, the sums are added up and solved, and isotonic regression on
rows that were not fitted turns the ridge scores into probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .batches import decoded, stored
from .calibration import Isotonic, fit_isotonic

STATISTICS = (
    "log_chars",
    "log_words",
    "mean_word",
    "long_words",
    "short_words",
    "letters",
    "upper",
    "digits",
    "spaces",
    "stops",
    "marks",
    "symbols",
    "lines",
    "distinct_words",
    "most_frequent",
    "distinct_lines",
    "distinct_pairs",
    "entropy",
)


@dataclass(frozen=True)
class Settings:
    """Number of cosines, width of the kernel in standard deviations, ridge penalty, bins of the calibration."""

    features: int = 256
    width: float = 4.0
    ridge: float = 1.0
    bins: int = 400
    seed: int = 20


def _byte_class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_LETTERS = _byte_class(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_UPPER = _byte_class(bytes(range(65, 91)))
_DIGITS = _byte_class(b"0123456789")
_SPACES = _byte_class(b" \t\r\n")
_STOPS = _byte_class(b".,;:")
_MARKS = _byte_class(b"!?'\"()-")
_SYMBOLS = ~(_LETTERS | _DIGITS | _SPACES | _STOPS | _MARKS)


def statistics(data: bytes | None) -> list[float]:
    """The values of STATISTICS for a text in UTF-8; those of a null text are those of an empty one."""
    data = data or b""
    size = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts[counts > 0] / size
    words = data.split()
    total = max(1, len(words))
    lengths = np.array([len(w) for w in words]) if words else np.zeros(1)
    frequent = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float((lengths < 4).mean()),
        counts[_LETTERS].sum() / size,
        counts[_UPPER].sum() / size,
        counts[_DIGITS].sum() / size,
        counts[_SPACES].sum() / size,
        counts[_STOPS].sum() / size,
        counts[_MARKS].sum() / size,
        counts[_SYMBOLS].sum() / size,
        np.log1p(len(lines)) / np.log1p(total),
        len(frequent) / total**0.75,
        max(frequent.values(), default=0) / total,
        len(set(lines)) / max(1, len(lines)),
        pairs / max(1, len(words) - 1),
        float(-(shares * np.log2(shares)).sum()),
    ]


_MEASURED = StructType([StructField("doc_id", LongType()), StructField("statistics", ArrayType(DoubleType(), False), False)])


def measure(documents: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row of (doc_id, binary text)."""

    def measure_batches(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            rows = [statistics(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=_MEASURED.names)

    return documents.select("doc_id", "text").mapInArrow(measure_batches, _MEASURED)


@dataclass
class Quality:
    """Standardisation, projection, ridge weights and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    calibrated: Isotonic

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        """A constant and the cosines; values more than six deviations off count as six."""
        standard = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(rows), 1)), np.cos(standard @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.cosines(rows) @ self.weights


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), len(STATISTICS))


def _normal_equations(labelled: DataFrame, model: Quality) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of (statistics, label), made in every partition and then added by matrix row."""
    size = len(model.phase) + 1
    schema = StructType([StructField("row", IntegerType()), StructField("sums", ArrayType(DoubleType()))])

    def partial(batches: Iterable[pa.RecordBatch]):
        sums = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.cosines(_matrix(batch.column("statistics")))
                sums[:, :size] += z.T @ z
                sums[:, size] += z.T @ np.array(batch.column("label").to_pylist(), float)
        if sums[0, 0]:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], names=schema.names)

    def add(table):  # no annotations: Spark would read them
        sums = np.sum(np.array(table.column("sums").to_pylist()), axis=0)
        return pa.table([table.column("row")[:1], pa.array([sums], pa.list_(pa.float64()))], names=schema.names)

    rows = labelled.select("statistics", "label").mapInArrow(partial, schema).groupBy("row").applyInArrow(add, schema).collect()
    sums = np.zeros((size, size + 1))
    for row in rows:
        sums[row["row"]] = row["sums"]
    return sums[:, :size], sums[:, size]


def fit(measured: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Quality:
    """Learn from (doc_id, statistics) of all documents and (doc_id, label 0 or 1).

    Means and deviations are those of all documents. Two thirds of the labelled rows, by a hash of
    the id, give the normal equations, the others the calibration; what reaches the driver has the
    size of the features and of the bins. Null labels teach nothing; of several labels of a document
    the largest counts. Without labels every score is 0.
    """
    size = len(STATISTICS)
    parts = [F.avg(F.col("statistics")[i]) for i in range(size)] + [F.stddev_pop(F.col("statistics")[i]) for i in range(size)]
    moments = np.array([value or 0.0 for value in measured.agg(*parts).first()])
    random = np.random.RandomState(settings.seed)
    projection = random.normal(0, 1 / settings.width, (size, settings.features))
    phase = random.uniform(0, 2 * np.pi, settings.features)
    model = Quality(moments[:size], np.maximum(moments[size:], 1e-9), projection, phase, np.zeros(settings.features + 1), Isotonic(np.zeros(0), np.zeros(0)))

    clean = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    labelled = stored(measured.join(clean, "doc_id").withColumn("fitted", F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0), "quality-labels")
    if not labelled.limit(1).collect():
        return model
    matrix, right = _normal_equations(labelled.filter("fitted"), model)
    model.weights = np.linalg.solve(matrix + settings.ridge * np.eye(len(matrix)), right)

    schema = StructType([StructField("bin", LongType()), StructField("n", LongType()), StructField("positive", LongType())])

    def tally(batches: Iterable[pa.RecordBatch]):
        seen: dict[int, list[int]] = {}
        for batch in batches:
            if batch.num_rows:
                bins = np.floor(np.clip(model.raw(_matrix(batch.column("statistics"))), -1, 2) * settings.bins).astype(np.int64)
                for b, label in zip(bins.tolist(), batch.column("label").to_pylist(), strict=True):
                    own = seen.setdefault(b, [0, 0])
                    own[0] += 1
                    own[1] += label
        columns = [pa.array(list(seen), pa.int64()), pa.array([n for n, _ in seen.values()], pa.int64()), pa.array([p for _, p in seen.values()], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    def tallied(rows: DataFrame) -> np.ndarray:
        sums = rows.select("statistics", "label").mapInArrow(tally, schema).groupBy("bin").agg(F.sum("n").alias("n"), F.sum("positive").alias("p")).collect()
        return np.array([(r["bin"], r["n"], r["p"]) for r in sums], float).reshape(-1, 3)

    bins = tallied(labelled.filter("NOT fitted"))
    bins = bins if len(bins) else tallied(labelled)
    model.calibrated = fit_isotonic(bins[:, 0] / settings.bins, bins[:, 1], bins[:, 2])
    return model


def predict(measured: DataFrame, model: Quality) -> DataFrame:
    """(doc_id, score) of every row of (doc_id, statistics)."""
    schema = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType(), False)])

    def score(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            raw = model.raw(_matrix(batch.column("statistics"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.calibrated(raw))], names=schema.names)

    return measured.select("doc_id", "statistics").mapInArrow(score, schema)
