"""Speed, pace and motivation from positions (user, spot, ts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import pace
from millrace.plans import panes
from millrace.plans.ordered import (
    Chunked,
    chunked,
    fold_min,
    fold_sum,
    previous,
    running,
)
from millrace.plans.sizing import broadcast_if_small

# Integer microseconds and integer spots make every sum exact, so results do not
# depend on how rows were partitioned.


def _in_order(positions: DataFrame, tie: str, chunks: int | None) -> Chunked:
    rows = positions.select("user", "spot", panes.micros(F.col("ts")).alias("_us"), tie)
    return chunked(rows, ["_us", tie], keys=["user"], chunks=chunks)


def _steps(parts: Chunked) -> DataFrame:
    """Each position with the distance and duration since the user's previous one."""
    rows = previous(parts, ["spot", "_us"])
    return rows.withColumns(
        {
            "distance": F.abs(F.col("spot") - F.col("prev_spot")).cast("bigint"),
            "duration": F.col("_us") - F.col("prev__us"),
        }
    )


def track_speed(positions: DataFrame, tie: str, chunks: int | None = None) -> DataFrame:
    """Path length over time per user; 0 where no time passed."""
    steps = _steps(_in_order(positions, tie, chunks))
    totals = steps.groupBy("user").agg(
        F.coalesce(F.sum("distance"), F.lit(0)).alias("distance"),
        (F.max("_us") - F.min("_us")).alias("duration"),
    )
    return totals.select(
        "user", pace.speed(F.col("distance"), F.col("duration")).alias("speed")
    )


def running_track_speed(
    positions: DataFrame, tie: str, chunks: int | None = None
) -> DataFrame:
    """After each position: the user's speed so far."""
    parts = _in_order(positions, tie, chunks)
    steps = _steps(parts).withColumn("distance", F.coalesce("distance", F.lit(0)))
    totals = running(
        parts.with_rows(steps),
        {"so_far": fold_sum(F.col("distance")), "first_us": fold_min(F.col("_us"))},
    )
    duration = F.col("_us") - F.col("first_us")
    return totals.select(
        "user",
        tie,
        panes.from_micros(F.col("_us")).alias("ts"),
        pace.speed(F.col("so_far"), duration).alias("speed"),
    )


def track_speed_sql(positions: DataFrame, width: int = 5 * panes.SECOND) -> DataFrame:
    """Net range of spots over range of time, per user and window, in SQL.

    Unlike ``track_speed`` this is not a path length: going back and forth counts
    only as far as the extremes lie apart.
    """
    return positions.sparkSession.sql(
        f"""
        WITH spans AS (
            SELECT user, window,
                   max(spot) - min(spot) AS distance,
                   unix_micros(max(ts)) - unix_micros(min(ts)) AS duration
            FROM {{positions}}
            GROUP BY user, window(ts, '{panes.duration(width)}')
        )
        SELECT user,
               window.start AS window_start,
               window.end AS window_end,
               CASE WHEN duration = 0 THEN 0.0D
                    ELSE distance * 1000000.0D / duration END AS speed
        FROM spans
        """,
        positions=positions,
    )


def position_pairs(positions: DataFrame, tie: str, chunks: int | None = None) -> DataFrame:
    """Distance and duration (microseconds) between consecutive positions.

    Each is stamped with the time of the earlier position.
    """
    steps = _steps(_in_order(positions, tie, chunks)).where(F.col("duration").isNotNull())
    return steps.select(
        "user",
        panes.from_micros(F.col("prev__us")).alias("ts"),
        "distance",
        "duration",
    )


def boxed_metrics(positions: DataFrame, tie: str, chunks: int | None = None) -> DataFrame:
    """The pairs of positions between which time passed."""
    return position_pairs(positions, tie, chunks).where(F.col("duration") > 0)


def mean_pace(metrics: DataFrame) -> DataFrame:
    """Ratio of sums per user; NaN where no time passed."""
    sums = metrics.groupBy("user").agg(
        F.sum("distance").alias("distance"), F.sum("duration").alias("duration")
    )
    return sums.select("user", pace.mean_pace(F.col("distance"), F.col("duration")).alias("pace"))


def _metric_sums(metrics: DataFrame, size: int, period: int) -> DataFrame:
    sums = {"distance": F.col("distance"), "duration": F.col("duration")}
    return panes.sliding_sums(metrics, "ts", size, period, sums, keys=["user"])


def _average(sums: DataFrame, short: int, name: str) -> DataFrame:
    """Pace per window, placed in the short window that holds the window's last tick."""
    last_tick = panes.micros(F.col("window_end")) - 1
    placed = panes.from_micros(panes.floor_to(last_tick, short))
    return sums.select(
        "user",
        placed.alias("window_start"),
        pace.mean_pace(F.col("distance"), F.col("duration")).alias(name),
    )


def short_average(metrics: DataFrame, short: int) -> DataFrame:
    """Pace per user and short tumbling window."""
    return _average(_metric_sums(metrics, short, short), short, "short_avg")


def long_average(metrics: DataFrame, short: int, long: int) -> DataFrame:
    """Pace per user and long window sliding by ``short``, keyed by its short window."""
    return _average(_metric_sums(metrics, long, short), short, "long_avg")


def _paired_averages(metrics: DataFrame, short: int, long: int) -> DataFrame:
    sums = _metric_sums(metrics, short, short)
    start = panes.micros(F.col("window_start"))
    reach = Window.partitionBy("user").orderBy(start).rangeBetween(short - long, 0)

    def long_sum(column: str) -> Column:
        return F.sum(column).over(reach)

    return sums.select(
        "user",
        "window_start",
        pace.mean_pace(F.col("distance"), F.col("duration")).alias("short_avg"),
        pace.mean_pace(long_sum("distance"), long_sum("duration")).alias("long_avg"),
    )


def _with_status(paired: DataFrame) -> DataFrame:
    status = pace.pace_status(F.col("short_avg"), F.col("long_avg"))
    return (
        paired.withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select("user", "window_start", "status")
    )


def _paired(metrics: DataFrame, short: int, long: int) -> DataFrame:
    """The short and the long pace of each user and short window that has both.

    Where short windows tile the long ones, both come from one pass over the short
    windows' sums: the long sums are a range frame over them.  A user has one row per
    short window there, however many positions.  Otherwise the two averages meet in one
    aggregate over their union, with at most one pace each per group.
    """
    if long % short == 0:
        return _paired_averages(metrics, short, long)
    shorts = short_average(metrics, short)
    longs = long_average(metrics, short, long)
    sides = shorts.unionByName(longs, allowMissingColumns=True)
    paired = sides.groupBy("user", "window_start").agg(
        F.max("short_avg").alias("short_avg"), F.max("long_avg").alias("long_avg")
    )
    return paired.where("short_avg IS NOT NULL AND long_avg IS NOT NULL")


def motivation_cogroup(metrics: DataFrame, short: int, long: int) -> DataFrame:
    """Status per user and short window, from co-grouping both averages."""
    return _with_status(_paired(metrics, short, long))


def motivation_side_input(metrics: DataFrame, short: int, long: int) -> DataFrame:
    """The same with the long averages as a side input: broadcast while small.

    A metric is copied into each long window it lies in, so the metrics' size times these
    bounds the side input.
    """
    longs = broadcast_if_small(
        long_average(metrics, short, long), made_from=metrics, copies=-(-long // short)
    )
    paired = short_average(metrics, short).join(longs, ["user", "window_start"])
    return _with_status(paired)


def motivation_sql(metrics: DataFrame, short: int, long: int) -> DataFrame:
    """The SQL form, which keeps a short pace of zero as underperforming."""
    return metrics.sparkSession.sql(
        """
        SELECT user, window_start,
               CASE WHEN share < :low THEN 'underperforming' WHEN share < :high THEN 'pacing'
                    ELSE 'outperforming' END AS performance
        FROM (SELECT user, window_start, try_divide(short_avg, long_avg) AS share FROM {paces})
        """,
        args={"low": pace.UNDERPERFORMING_BELOW, "high": pace.PACING_BELOW},
        paces=_paired(metrics, short, long),
    )
