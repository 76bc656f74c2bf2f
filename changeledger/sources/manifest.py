"""Repo manifest XML to projects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.project_fields import encode_project
from ..schemas import MANIFEST
from .whole_files import read_whole_files


def read_manifest(spark: SparkSession, path: str | list[str], root_tag: str = "manifest") -> DataFrame:
    """Distinct (id, name, ref_name) of the projects directly under the root.

    One `.git` suffix is removed from a name and the id is the encoded name. A project without a
    revision gets the trimmed default one of its manifest, or '' when there is no default.
    Projects without a name are skipped. XML that is not well-formed, and a file without the root,
    fail the load.
    """
    strict = {"rowTag": root_tag, "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}
    parsed = spark.read.format("xml").options(**strict).schema(MANIFEST).load(path)
    # The parser skips a file in which it finds no root, so every file is counted against its rows.
    files = read_whole_files(spark, path).select(F.col("_metadata.file_path").alias("file"))
    rows = parsed.select("*", F.col("_metadata.file_path").alias("parsed_file"))
    missing = F.raise_error(F.concat(F.lit(f"malformed manifest, no <{root_tag}>: "), F.col("file")))
    joined = files.join(rows, F.col("file") == F.col("parsed_file"), "left")
    manifests = joined.select("default", F.when(F.col("parsed_file").isNotNull(), F.col("project")).otherwise(missing).alias("project"))
    default = F.array_join(F.coalesce(F.col("default._revision"), F.array().cast("array<string>")), "")
    entries = manifests.select(F.btrim(default, F.lit(" \t\r\n")).alias("default_ref"), F.explode("project").alias("entry"))
    name = F.regexp_replace(F.col("entry._name"), r"\.git\z", "")
    return (
        entries.where(F.col("entry._name").isNotNull())
        .select(
            encode_project(name).alias("id"),
            name.alias("name"),
            F.coalesce(F.col("entry._revision"), F.col("default_ref")).alias("ref_name"),
        )
        .distinct()
    )
