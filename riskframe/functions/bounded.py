"""Guards around the few places where a small table leaves the cluster or is broadcast."""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

SMALL_ROWS = 10_000


def collect_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> list[Row] | None:
    """The rows when there are at most ``max_rows`` of them, else None."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def join_lookup(df: DataFrame, lookup: DataFrame, on, how: str = "left",
                max_rows: int = SMALL_ROWS) -> DataFrame:
    """Join a table that is usually tiny: broadcast when checked small, shuffled otherwise."""
    rows = collect_small(lookup, max_rows)
    if rows is None:
        return df.join(lookup, on, how)
    local = df.sparkSession.createDataFrame(rows, lookup.schema)
    return df.join(F.broadcast(local), on, how)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Persist for several passes unless the caller already did; released on exit."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
