"""Time windows as arithmetic on epoch microseconds.

Sliding windows are computed from panes: rows are first summed into
non-overlapping panes of ``gcd(size, period)``, and only pane sums, not rows, are
copied into the windows they belong to.  A 100 s window sliding by 20 s would
otherwise shuffle every row five times.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value)


def floor_to(value: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``value``; right for negatives too."""
    return value - F.pmod(value, F.lit(width).cast("bigint"))


def duration(width: int) -> str:
    return f"{width} microseconds"


def tumbling(ts: str, width: int) -> Column:
    """The built-in window column, usable on bounded and streaming tables."""
    return F.window(F.col(ts), duration(width))


def with_bounds(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def _window_starts(size: int, period: int, width: int) -> Column:
    """Starts of the windows that contain a pane; none in the gap between windows."""
    pane = F.col("_pane")
    step = F.lit(period).cast("bigint")
    first = pane + F.lit(width - size).cast("bigint")
    first = first + F.pmod(-first, step)
    last = floor_to(pane, period)
    starts = F.sequence(first, last, step)
    if period <= size:
        return starts
    return F.when(first <= last, starts).otherwise(F.array().cast("array<bigint>"))


def sliding_sums(
    df: DataFrame,
    ts: str,
    size: int,
    period: int,
    sums: dict[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sums per key and sliding window, as keys, window_start, window_end, sums."""
    totals = [F.sum(value).alias(name) for name, value in sums.items()]
    if df.isStreaming:
        # The values are made before rows are copied into their windows.
        values = [value.alias(f"_of_{name}") for name, value in sums.items()]
        window = F.window(F.col(ts), duration(size), duration(period))
        copied = df.select(ts, *keys, *values).groupBy(window, *keys)
        return with_bounds(copied.agg(*[F.sum(f"_of_{n}").alias(n) for n in sums]))
    width = gcd(size, period)
    at = micros(F.col(ts))
    panes = df.groupBy(*keys, floor_to(at, width).alias("_pane")).agg(*totals)
    if size == period:
        merged = panes.withColumnRenamed("_pane", "_start")
    else:
        placed = panes.select(
            *keys, F.explode(_window_starts(size, period, width)).alias("_start"), *sums
        )
        merged = placed.groupBy(*keys, "_start").agg(*[F.sum(n).alias(n) for n in sums])
    return merged.select(
        *keys,
        from_micros(F.col("_start")).alias("window_start"),
        from_micros(F.col("_start") + size).alias("window_end"),
        *sums,
    )
