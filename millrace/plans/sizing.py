"""Decisions taken from measured or estimated sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate.

    Filters and aggregates keep their input's size in this estimate.  Two things make it
    too small: a scan counts as its compressed files, and rows made by ``explode`` don't
    count.  So take it before a fan-out, and keep limits well below what memory allows.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes())


def broadcast_if_small(
    df: DataFrame,
    limit: int = BROADCAST_LIMIT_BYTES,
    made_from: DataFrame | None = None,
    copies: int = 1,
) -> DataFrame:
    """Hint a broadcast below ``limit``; above it leave the join to AQE.

    AQE still turns the join into a broadcast when the shuffled size allows, and
    splits skewed partitions of a sort-merge join otherwise.  A table made with up to
    ``copies`` rows of each row of another is measured by that one.
    """
    measured = df if made_from is None else made_from
    return F.broadcast(df) if estimated_bytes(measured) * copies <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer splits than the cluster has cores.

    A table made of one unsplittable file would otherwise run its whole text processing
    in one task.  What is shuffled has less than one split per core, so it is bounded by
    the cluster, not by the table.  ``df`` is a scan, so that counting its splits runs
    nothing.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
