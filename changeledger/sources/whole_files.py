"""Files that are read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`value` and file metadata of each file; an empty file is an error.

    Spark leaves empty files out of what it reads, so they are only seen by their number.
    """
    files = spark.read.text(path, wholetext=True)
    listed, read = len(files.inputFiles()), files.count()
    if read < listed:
        raise ValueError(f"malformed input, {listed - read} of {listed} files are empty: {path}")
    return files
