"""Arrow batches of documents inside tasks, and folds of document ids."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.session import scratch_dir

GROUP_BYTES = 8 << 20
RECORDS_PER_BATCH = "256"


def small_batches(spark: SparkSession) -> SparkSession:
    """Few rows per Arrow batch, because one text can be long; tasks regroup batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", RECORDS_PER_BATCH)
    return spark


def grouped(batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Join batches until they hold `limit` bytes; only one group is in memory at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= limit:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def decoded(column: pa.Array) -> list[str | None]:
    """Texts of a binary column; bytes that are no UTF-8 become replacement characters."""
    return [None if value is None else value.decode("utf-8", "replace") for value in column.to_pylist()]


def as_bytes(column: str) -> Column:
    """A text column in UTF-8."""
    return F.col(column).cast("string").cast("binary")


def id_and_text(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns that matter, as `doc_id` and binary `text`; other columns, however named, go."""
    return documents.select(F.col(id_column).cast("bigint").alias("doc_id"), as_bytes(text_column).alias("text"))


def fold_is(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: lineage is cut, executors may be lost."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def with_row(frame: DataFrame, **columns: Column) -> DataFrame:
    """All columns as one struct `row` beside new ones, so that no name can clash; undone by `row.*`."""
    return frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"), *[column.alias(name) for name, column in columns.items()])
