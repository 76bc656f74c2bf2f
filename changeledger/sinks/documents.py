"""Result writers: JSON documents, and any named target of a Spark writer format."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Target:
    """A place to write to; `format` is any Spark data source, search connectors included."""

    path: str
    format: str = "json"
    mode: str = "errorifexists"
    options: Mapping[str, str] = field(default_factory=dict)


def write_documents(df: DataFrame, target: Target) -> None:
    df.write.format(target.format).mode(target.mode).options(**target.options).save(target.path)


def write_json(df: DataFrame, directory: str, mode: str = "errorifexists") -> None:
    """JSON documents; null fields are left out of them."""
    write_documents(df, Target(directory, "json", mode))


def write_all(df: DataFrame, targets: list[Target | None], count: bool = False) -> int | None:
    """Write to each configured target in order, computing the frame once.

    The frame is kept only when it is used more than once. Blocks lost with an executor are
    recomputed from the sources. Returns the row count when asked for.
    """
    wanted = [target for target in targets if target is not None]
    uses = len(wanted) + int(count)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK) if uses > 1 else df
    try:
        rows = kept.count() if count else None
        for target in wanted:
            write_documents(kept, target)
        return rows
    finally:
        if uses > 1:
            kept.unpersist()
