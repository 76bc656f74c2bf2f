"""Which names of a chunk of documents are repeated anywhere: sorted runs, merged by range.

Names are 64-bit numbers that stand for strings or n-grams. A chunk sends its distinct names, sorted
and packed as differences; a range of all names merges the runs it gets, compares neighbours, and
answers each run with one bit per name.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from changeledger.session import scratch_dir

from .batches import grouped

#: Documents are kept together until a chunk has this many bytes.
CHUNK_BYTES = 4 << 20
#: Answers of this many bytes at most are sent to all executors; more are dealt to the buckets of their chunks.
BROADCAST_BYTES = 8 << 20
#: Bytes of text in a bucket of chunks, about.
BUCKET_BYTES = 16 << 20
#: A chunk's names that are sorted at a time, about.
NAMES_AT_ONCE = 1 << 19


def names_bits(names: float) -> int:
    """How many bits of a name to keep so that one in some thousands is taken for another's."""
    return min(64, max(40, 8 * math.ceil((math.log2(names + 1) + 12) / 8)))


def pack(names: np.ndarray) -> bytes:
    """Sorted distinct names as the bytes of their differences, planes of equal significance together."""
    steps = np.diff(names, prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


CHUNKS = StructType([StructField("chunk", LongType(), False), StructField("doc_ids", ArrayType(LongType()), False), StructField("lengths", ArrayType(LongType(), False), False), StructField("data", BinaryType(), False)])
RUNS = StructType([StructField("chunk", LongType()), StructField("part", IntegerType()), StructField("own", BinaryType()), StructField("names", BinaryType())])
ANSWERS = StructType([StructField("chunk", LongType()), StructField("part", IntegerType()), StructField("bits", BinaryType()), StructField("n", LongType())])


def _chunks(documents: DataFrame) -> DataFrame:
    """Documents as chunks; a chunk's number is that of its partition and its place there."""

    def lay(batches: Iterable[pa.RecordBatch]):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in grouped(batches, CHUNK_BYTES):
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            columns = [
                pa.array([number], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([b"".join(texts)], pa.binary()),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(columns, names=CHUNKS.names)

    return documents.select("doc_id", "text").mapInArrow(lay, CHUNKS)


def bucket_count(total: int) -> int:
    """Into how many buckets chunks of so many bytes in all are written; Spark allows 100,000."""
    return min(100_000, int(total / BUCKET_BYTES) + 1)


def written_chunks(documents: DataFrame) -> tuple[DataFrame, int]:
    """Write the chunks once, in the shared scratch folder, and give their bytes of text.

    Every pass reads them from there, few at a time. They lie in buckets by number, about one chunk to a
    file: a join by chunk deals out only the other side, and no reader holds many chunks at once.
    """
    spark = documents.sparkSession
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    name, path = f"changeledger_chunks_{uuid.uuid4().hex}", scratch_dir(spark, "chunks")
    # Only a table can be read by its buckets; its entry goes again, the files stay.
    _chunks(documents).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(bucket_count(total), "chunk").saveAsTable(name)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return chunks, total


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Chunks one by one, however many a batch has."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def texts_of(row: dict) -> list[bytes]:
    """The texts of a chunk."""
    ends = np.cumsum(row["lengths"]).tolist()
    return [row["data"][end - length : end] for end, length in zip(ends, row["lengths"], strict=True)]


def _blocks(names: np.ndarray, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbouring ranges, few names at a time: the ranges of a block, its end included, and which names are in them."""
    blocks = max(1, min(parts, len(names) // NAMES_AT_ONCE))
    for first, end in ((b * parts // blocks, (b + 1) * parts // blocks) for b in range(blocks)):
        inside = names >= np.uint64(-(-(first << 32) // parts) << 32)
        if end < parts:
            inside &= names < np.uint64(-(-(end << 32) // parts) << 32)
        yield np.arange(first, end + 1), inside


def _edges(distinct: np.ndarray, parts: int, ranges: np.ndarray) -> np.ndarray:
    """Where each of the ranges begins in sorted names."""
    return np.searchsorted((distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), ranges)


def sorted_runs(chunk: int, names: np.ndarray, parts: int) -> pa.RecordBatch:
    """The chunk's distinct names by range, and which of them it has more than once."""
    rows = []
    for ranges, inside in _blocks(names, parts):
        distinct, counts = np.unique(names[inside], return_counts=True)
        edges = _edges(distinct, parts, ranges).tolist()
        rows += [(p, np.packbits(counts[a:b] > 1).tobytes(), pack(distinct[a:b])) for p, a, b in zip(ranges[:-1].tolist(), edges[:-1], edges[1:], strict=True) if a < b]
    numbers, own, packed = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), pa.array(numbers, pa.int32()), pa.array(own, pa.binary()), pa.array(packed, pa.binary())], names=RUNS.names)


def repeated_names(answers: list[dict] | None, names: np.ndarray, parts: int) -> np.ndarray:
    """Whether each of a chunk's names is repeated, from the answers of the ranges."""
    packed = {answer["part"]: answer["bits"] for answer in answers or ()}
    out = np.zeros(len(names), bool)
    for ranges, inside in _blocks(names, parts):
        distinct, back = np.unique(names[inside], return_inverse=True)
        edges = _edges(distinct, parts, ranges).tolist()
        bits = np.zeros(len(distinct), bool)
        for p, a, b in zip(ranges[:-1].tolist(), edges[:-1], edges[1:], strict=True):
            if p in packed:
                bits[a:b] = np.unpackbits(np.frombuffer(zlib.decompress(packed[p]), np.uint8), count=b - a).astype(bool)
        out[inside] = bits[back]
    return out


def merge_runs(runs: DataFrame, parts: int) -> DataFrame:
    """Merge the sorted runs of each range and tell every chunk which of its names are repeated."""

    def merge(key, table):  # no annotations: Spark would read them
        names = [unpack(run) for run in table.column("names").to_pylist()]
        merged = np.concatenate(names)
        order = np.argsort(merged, kind="stable")
        ranked = merged[order]
        same = ranked[1:] == ranked[:-1]
        repeated = np.zeros(len(ranked), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        bits, ones, at = [], [], 0
        for own, run in zip(table.column("own").to_pylist(), names, strict=True):
            inside = np.unpackbits(np.frombuffer(own, np.uint8), count=len(run)).astype(bool)
            inside |= repeated[at : at + len(run)]
            bits.append(zlib.compress(np.packbits(inside).tobytes(), 1))
            ones.append(int(inside.sum()))
            at += len(run)
        return pa.table([table.column("chunk"), table.column("part"), pa.array(bits, pa.binary()), pa.array(ones, pa.int64())], names=ANSWERS.names)

    return runs.repartition(parts, "part").groupBy("part").applyInArrow(merge, ANSWERS)


def with_answers(chunks: DataFrame, total: int, *answers: DataFrame) -> DataFrame:
    """Each chunk with the answers it got; few bytes are broadcast, more are dealt to the chunks' buckets.

    The chunks stay where they are: what is shuffled is the answers, in as many parts as there are buckets.
    """
    out = chunks
    for position, frame in enumerate(answers):
        size = frame.agg(F.sum(F.length("bits") + 32)).first()[0] or 0
        few = size <= BROADCAST_BYTES
        dealt = frame if few else frame.repartition(bucket_count(total), "chunk")
        per_chunk = dealt.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(f"answers_{position}"))
        out = out.join(F.broadcast(per_chunk) if few else per_chunk.hint("shuffle_hash"), "chunk", "left")
    return out
