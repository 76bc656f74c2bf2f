"""Session settings the package relies on, and scratch space for staged files."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable options. Skew-join splitting and runtime broadcast conversion are what keep
# the unhinted lookup joins safe when one key holds a large share of the rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

UTC_ZONES = ("UTC", "Etc/UTC", "Z", "+00:00", "GMT")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the options every plan here assumes (UTC buckets, adaptive execution)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_utc(df: DataFrame) -> DataFrame:
    """The frame, if its session reads times as UTC; buckets would be off without a message otherwise."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_ZONES:
        raise ValueError(f"the session time zone is '{zone}'; call configure(spark) or set it to UTC")
    return df


def local_session(app_name: str = "changeledger", cores: int | str = 8, **conf: str) -> SparkSession:
    """A `local[n]` session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory for staged files.

    It lies in the shared folder named by `spark.checkpoint.dir`. Without that setting only a `local`
    master may use a temporary folder: on a cluster every executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/changeledger-{label}-{uuid.uuid4().hex}"
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"changeledger-{label}-") + "/data"
