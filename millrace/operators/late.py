"""Separating rows that come too late for their window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans import panes
from millrace.plans.ordered import chunked, fold_max, running


def is_late(window_end: Column, lateness: int, watermark: Column) -> Column:
    """Whether the watermark already passed the window's end plus the allowance."""
    return F.coalesce(watermark >= window_end + lateness, F.lit(False))


def split_late(
    arrivals: DataFrame,
    order: list[str],
    width: int,
    lateness: int,
    delay: int = 0,
    ts: str = "ts",
    watermark: str | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Tag each row with its window and whether it is droppable.

    The watermark a row meets is the latest event time among earlier arrivals,
    minus ``delay``; a column of watermarks in epoch microseconds may be given
    instead.  A late row is found even if it is the first of its window.
    """
    at = panes.micros(F.col(ts))
    rows = arrivals.withColumn("_us", at)
    if watermark is None:
        parts = chunked(rows, order, chunks=chunks)
        rows = running(parts, {"_seen": fold_max(F.col("_us"))}, include_current=False)
        met = F.col("_seen") - delay
    else:
        met = F.col(watermark)
    start = panes.floor_to(F.col("_us"), width)
    tagged = rows.withColumns(
        {
            "window_start": panes.from_micros(start),
            "window_end": panes.from_micros(start + width),
            "droppable": is_late(start + width, lateness, met),
        }
    )
    return tagged.select(*arrivals.columns, "window_start", "window_end", "droppable")


def outputs(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Main rows with their window, and droppable rows without."""
    main = tagged.where(~F.col("droppable")).drop("droppable")
    late = tagged.where("droppable").drop("window_start", "window_end", "droppable")
    return main, late
