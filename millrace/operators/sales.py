"""Profit of store sales in windows, sessions and count panes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import panes
from millrace.plans.ordered import chunked, fold_count, fold_max, previous, running


def profit_by_row(sales: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    """Profit of each sale, kept to the given cities."""
    if cities is not None:
        sales = sales.where(F.col("city").isin(list(cities)))
    margin = F.col("sell_price") - F.col("buy_rate")
    return sales.withColumn("profit", (margin * F.col("pieces")).cast("bigint"))


def tumble_profit(profits: DataFrame, width: int, key: str = "city", ts: str = "ts") -> DataFrame:
    """Profit per key and tumbling window: what the last firing of a window shows."""
    sums = profits.groupBy(panes.tumbling(ts, width), key).agg(F.sum("profit").alias("profit"))
    return panes.with_bounds(sums)


def sliding_profit(
    profits: DataFrame, size: int, period: int, key: str = "city", ts: str = "ts"
) -> DataFrame:
    return panes.sliding_sums(
        profits, ts, size, period, {"profit": F.col("profit")}, keys=[key]
    )


def session_profit(
    profits: DataFrame,
    gap: int,
    key: str = "city",
    ts: str = "ts",
    merge_touching: bool = True,
    chunks: int | None = None,
) -> DataFrame:
    """Profit per key and session; a session ends when nothing comes for ``gap``.

    Rows are first summed into cells of width ``gap``, since two rows of a cell
    always share a session.  The order of a key's cells is cut into chunks.  Within a chunk
    a cell opens a session if its predecessor, in this chunk or the last one before, ended
    too long ago; the start of the session that is open at a chunk's end is carried into
    those that follow.  So a key with most of the cells, or a session as long as many
    chunks, needs no task of its own, and sessions are sums over their starts.

    Rows exactly one gap apart are one session as in ``session_window``;
    ``merge_touching=False`` keeps them apart.  Streams use ``session_window`` itself.
    """
    if profits.isStreaming:
        window = F.session_window(ts, panes.duration(gap)).alias("window")
        open_sums = profits.groupBy(window, key).agg(F.sum("profit").alias("profit"))
        return panes.with_bounds(open_sums).select(key, "window_start", "window_end", "profit")
    at = panes.micros(F.col(ts))
    placed = profits.withColumn("_cell", panes.floor_to(at, gap))
    cells = placed.groupBy(key, "_cell").agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"), F.sum("profit").alias("profit")
    )
    # The rows have the same keys and cells; a sample of them needs no sums.
    parts = chunked(cells, ["_cell"], keys=[key], chunks=chunks, sample_from=placed)
    ordered = previous(parts, ["_last"])
    idle = F.col("_first") - F.col("prev__last")
    ended = idle > gap if merge_touching else idle >= gap
    opens = F.when(F.coalesce(ended, F.lit(True)), F.col("_first"))
    marked = parts.with_rows(ordered.withColumn("_opens", opens))
    sessions = running(marked, {"_start": fold_max(F.col("_opens"))})
    sums = sessions.groupBy(key, "_start").agg(
        F.max("_last").alias("_end"), F.sum("profit").alias("profit")
    )
    return sums.select(
        key,
        panes.from_micros(F.col("_start")).alias("window_start"),
        panes.from_micros(F.col("_end") + gap).alias("window_end"),
        "profit",
    )


def global_count_discarding(
    profits: DataFrame,
    order: Sequence[str],
    every: int = 5,
    key: str = "city",
    chunks: int | None = None,
) -> DataFrame:
    """Per key, the profit of each run of ``every`` sales in order of arrival."""
    parts = chunked(profits, order, keys=[key], chunks=chunks)
    numbered = running(parts, {"_n": fold_count()})
    pane = F.floor((F.col("_n") - 1) / every).cast("bigint")
    return numbered.groupBy(key, pane.alias("pane")).agg(
        F.count("*").alias("sales"), F.sum("profit").alias("profit")
    )
