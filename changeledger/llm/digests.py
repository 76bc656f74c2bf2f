"""Quartile bucket digests: fingerprints that stay alike when a text is edited.

Bytes of a text three apart form triplets, hashed into buckets. A bucket is coded by the quarter of
all bucket counts it lies in, two bits each; one byte in front codes the length. Two digests differ
by the sum of their buckets' differences (0, 1, 2, and 6 for opposite quarters) against the most that
could be, and a little by length; the likeness is what is left to 1.

Null texts count as empty. Bytes that are no UTF-8 become replacement characters. Every byte counts,
however long the text; six zero bytes in front let the shortest texts have triplets. Equal texts have
equal digests. Documents are ordered by doc_id, null first; those that share it by a hash of their text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import stored

BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS

#: Distance between the bytes of a triplet: far enough to reach from one word into the next.
STEP = 3

#: Bytes of one text that are counted at a time.
SLICE_BYTES = 1 << 20

#: Difference of two bucket codes by their distance: opposite quarters count double.
CODE_DIFFERENCES = np.array([0, 1, 2, 6])

#: Average difference of the codes of unrelated texts, whose quarters are independent; more counts the same.
UNRELATED = 1.625

#: Weight of the length, and how many doublings make the most of it.
LENGTH_WEIGHT, LENGTH_DOUBLINGS = 0.05, 4


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of the text fall into each bucket; memory does not grow with the text."""
    counts = np.zeros(BUCKETS, np.int64)
    reach = 2 * STEP
    for start in range(0, len(data), SLICE_BYTES):
        before = data[max(0, start - reach) : start].rjust(reach, b"\0")
        window = np.frombuffer(before + data[start : start + SLICE_BYTES], np.uint8).astype(np.uint32)
        key = (window[:-reach] | window[STEP:-STEP] << np.uint32(8) | window[reach:] << np.uint32(16)) * np.uint32(2654435761)
        key = (key ^ key >> np.uint32(15)) * np.uint32(2246822519)
        counts += np.bincount(key >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> bytes:
    """One byte for the length (eighths of its binary logarithm), then four bucket codes a byte."""
    counts = bucket_counts(data)
    quarter = BUCKETS // 4
    bounds = np.partition(counts, [quarter - 1, 2 * quarter - 1, 3 * quarter - 1])[quarter - 1 :: quarter][:3]
    codes = (counts[:, None] > bounds).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return bytes([min(255, round(8 * math.log2(1 + len(data))))]) + packed.tobytes()


def _codes(packed: bytes) -> np.ndarray:
    of_four = np.frombuffer(packed, np.uint8, offset=1)
    return np.stack([of_four >> shift & 3 for shift in (0, 2, 4, 6)], axis=1).ravel().astype(np.int8)


def likeness(left: bytes, right: bytes) -> float:
    """From 0 to 1; 1 for equal digests. Buckets that are empty in both do not speak for likeness."""
    a, b = _codes(left), _codes(right)
    found = int(CODE_DIFFERENCES[np.abs(a - b)].sum())
    most = min(UNRELATED * BUCKETS, int(CODE_DIFFERENCES[a].sum() + CODE_DIFFERENCES[b].sum()))
    of_buckets = min(1.0, found / most) if most else 0.0
    of_length = min(1.0, abs(left[0] - right[0]) / 8 / LENGTH_DOUBLINGS)
    return 1.0 - ((1 - LENGTH_WEIGHT) * of_buckets + LENGTH_WEIGHT * of_length)


def edited_text(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as many characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_MEASURED = "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


class _Document(NamedTuple):
    doc_id: int | None
    text: str
    fingerprint: bytes


def _measures(document: _Document, following: _Document) -> tuple:
    edited = edited_text(document.text, following.text).encode()
    fingerprint = digest(edited)
    return (
        len(document.text), hashlib.sha256(edited).hexdigest(), document.fingerprint, fingerprint,
        likeness(document.fingerprint, fingerprint), likeness(document.fingerprint, following.fingerprint),
    )


def _document(doc_id: int | None, data: bytes | None) -> _Document:
    text = (data or b"").decode("utf-8", "replace")
    return _Document(doc_id, text, digest(text.encode()))


_UNMEASURED = (None,) * 6
_IN_ORDER = f"doc_id bigint, {_MEASURED}, part int, is_first boolean, is_last boolean, text binary"


def _measured_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Measure each document of a sorted partition against the next; first and last keep their text."""
    schema = _arrow_schema(_IN_ORDER)
    part = TaskContext.get().partitionId()
    waiting, is_first = None, True
    for batch in batches:
        rows = []
        for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            document = _document(doc_id, data.as_py())
            if waiting is not None:
                kept = waiting.text.encode() if is_first else None
                rows.append((waiting.doc_id, *_measures(waiting, document), part, is_first, False, kept))
                is_first = False
            waiting = document
        yield _batch(rows, schema)
    if waiting is not None:
        yield _batch([(waiting.doc_id, *_UNMEASURED, part, is_first, True, waiting.text.encode())], schema)


def _measured_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Measure documents (`doc_id`, `text`) against the `following` text."""
    schema = _arrow_schema(f"doc_id bigint, {_MEASURED}")
    for batch in batches:
        texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
        pairs = zip(batch.column("doc_id").to_pylist(), texts, following, strict=True)
        yield _batch([(doc_id, *_measures(_document(doc_id, text), _document(None, after))) for doc_id, text, after in pairs], schema)


_ARROW_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _arrow_schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _ARROW_TYPES[kind]) for name, kind in (field.split() for field in fields.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(values), field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)


def edited_likeness(documents: DataFrame) -> DataFrame:
    """Digests of every (`doc_id`, binary `text`) and of its edited text, and how alike they are.

    Documents are dealt by ranges of their order and sorted, so all but the last of a partition find
    the next document in their own task. The last ones are joined, by partition number, with the
    first of the next partition that has rows; the very last one with the very first.
    """
    in_order = documents.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    dealt = in_order.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    measured = stored(dealt.mapInArrow(_measured_in_order, _IN_ORDER), "digests")
    columns = ["doc_id", *[field.split()[0] for field in _MEASURED.split(", ")]]
    # One row a partition: the numbers meet in one window, the texts in a join.
    firsts = measured.where("is_first").select(F.col("part").alias("_part"), F.col("text").alias("following"))
    by_part = Window.orderBy("_part")
    around = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = firsts.select("_part", F.coalesce(F.lead("_part").over(by_part), F.min("_part").over(around)).alias("_next"))
    lasts = measured.where("is_last").select("doc_id", "text", "part").join(links, F.col("part") == F.col("_part")).select("doc_id", "text", "_next")
    pairs = lasts.join(firsts, F.col("_next") == F.col("_part")).select("doc_id", "text", "following")
    ends = pairs.mapInArrow(_measured_pairs, f"doc_id bigint, {_MEASURED}")
    return measured.where("NOT is_last").select(*columns).unionByName(ends.select(*columns))
