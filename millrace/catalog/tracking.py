"""Positions, pace and motivation over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.catalog.words import iso_sql, with_iso_bounds
from millrace.functions import pace
from millrace.functions.dates import iso_seconds
from millrace.operators import tracking as op
from millrace.plans import panes

SHORT = 6 * panes.HOUR
LONG = 24 * panes.HOUR

STEPS_SQL = """
    steps AS (
        SELECT user_id AS "user", event_id, epoch_us(ts) AS us,
               lag(epoch_us(ts)) OVER w AS prev_us,
               abs(CAST(floor(value) AS BIGINT)
                   - lag(CAST(floor(value) AS BIGINT)) OVER w) AS distance,
               epoch_us(ts) - lag(epoch_us(ts)) OVER w AS duration
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    )
"""
METRICS_SQL = f"""
    {STEPS_SQL},
    metrics AS (
        SELECT "user", prev_us AS us, distance, duration FROM steps WHERE duration > 0
    )
"""
SPEED_SQL = "CAST(sum(distance) AS DOUBLE) * 1e6 / sum(duration)"


@query(
    "track_speed",
    f"""
    WITH {STEPS_SQL}
    SELECT "user", CASE WHEN max(us) = min(us) THEN 0.0
                ELSE CAST(coalesce(sum(distance), 0) AS DOUBLE) * 1e6 / (max(us) - min(us))
                END AS speed
    FROM steps GROUP BY "user"
    """,
)
def track_speed(spark, sf_dir):
    return op.track_speed(t.positions(spark, sf_dir), "event_id")


@query(
    "running_track_speed",
    f"""
    WITH {STEPS_SQL},
    so_far AS (
        SELECT "user", event_id, us, sum(coalesce(distance, 0)) OVER w AS d, us - min(us) OVER w AS m
        FROM steps WINDOW w AS (PARTITION BY "user" ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)
    )
    SELECT "user", event_id, us AS ts_us,
           CASE WHEN m = 0 THEN 0.0 ELSE CAST(d AS DOUBLE) * 1e6 / m END AS speed
    FROM so_far
    """,
)
def running_track_speed(spark, sf_dir):
    speeds = op.running_track_speed(t.positions(spark, sf_dir), "event_id")
    return speeds.select("user", "event_id", F.unix_micros("ts").alias("ts_us"), "speed")


@query(
    "track_speed_sql",
    f"""
    SELECT user_id AS "user", {iso_sql("s")} AS window_start,
           {iso_sql(f"s + {panes.DAY}")} AS window_end,
           CASE WHEN max(us) = min(us) THEN 0.0
                ELSE (max(spot) - min(spot)) * CAST(1000000.0 AS DOUBLE) / (max(us) - min(us))
           END AS speed
    FROM (SELECT user_id, epoch_us(ts) AS us, epoch_us(ts) // {panes.DAY} * {panes.DAY} AS s,
                 CAST(floor(value) AS BIGINT) AS spot FROM events)
    GROUP BY user_id, s
    """,
)
def track_speed_sql(spark, sf_dir):
    return with_iso_bounds(op.track_speed_sql(t.positions(spark, sf_dir), panes.DAY))


@query(
    "boxed_metrics",
    f"""WITH {METRICS_SQL} SELECT "user", us AS ts_us, distance, duration FROM metrics""",
)
def boxed_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).select(
        "user", F.unix_micros("ts").alias("ts_us"), "distance", "duration"
    )


def _metrics(spark, sf_dir):
    return op.boxed_metrics(t.positions(spark, sf_dir), "event_id")


@query(
    "mean_pace",
    f"""WITH {METRICS_SQL} SELECT "user", {SPEED_SQL} AS pace FROM metrics GROUP BY "user" """,
)
def mean_pace(spark, sf_dir):
    return op.mean_pace(_metrics(spark, sf_dir))


AVERAGES_SQL = f"""
    {METRICS_SQL},
    shorts AS (
        SELECT "user", us // {SHORT} * {SHORT} AS s, {SPEED_SQL} AS short_avg
        FROM metrics GROUP BY 1, 2
    ),
    longs AS (
        SELECT "user", s + {LONG - SHORT} AS s, {SPEED_SQL} AS long_avg
        FROM (SELECT *, unnest(range(us // {SHORT} - {LONG // SHORT - 1}, us // {SHORT} + 1))
                        * {SHORT} AS s FROM metrics)
        GROUP BY 1, 2
    ),
    paired AS (SELECT "user", s, short_avg, long_avg FROM shorts JOIN longs USING ("user", s))
"""


def _short_start(df):
    return df.withColumn("window_start", iso_seconds(F.col("window_start")))


@query(
    "short_average",
    f"""WITH {AVERAGES_SQL}
        SELECT "user", {iso_sql("s")} AS window_start, short_avg FROM shorts""",
)
def short_average(spark, sf_dir):
    return _short_start(op.short_average(_metrics(spark, sf_dir), SHORT))


@query(
    "long_average",
    f"""WITH {AVERAGES_SQL}
        SELECT "user", {iso_sql("s")} AS window_start, long_avg FROM longs""",
)
def long_average(spark, sf_dir):
    return _short_start(op.long_average(_metrics(spark, sf_dir), SHORT, LONG))


STATUS_SQL = f"""
    CASE WHEN short_avg / long_avg < CAST({pace.UNDERPERFORMING_BELOW} AS DOUBLE)
         THEN 'underperforming'
         WHEN short_avg / long_avg < CAST({pace.PACING_BELOW} AS DOUBLE) THEN 'pacing'
         ELSE 'outperforming' END
"""
MOTIVATION_SQL = f"""
    WITH {AVERAGES_SQL}
    SELECT "user", {iso_sql("s")} AS window_start, {STATUS_SQL} AS status
    FROM paired WHERE short_avg <> 0 AND long_avg <> 0
"""


@query("motivation_cogroup", MOTIVATION_SQL)
def motivation_cogroup(spark, sf_dir):
    return _short_start(op.motivation_cogroup(_metrics(spark, sf_dir), SHORT, LONG))


@query("motivation_side_input", MOTIVATION_SQL)
def motivation_side_input(spark, sf_dir):
    return _short_start(op.motivation_side_input(_metrics(spark, sf_dir), SHORT, LONG))


@query(
    "motivation_sql",
    f"""
    WITH {AVERAGES_SQL}
    SELECT "user", {iso_sql("s")} AS window_start,
           CASE WHEN long_avg = 0 THEN 'outperforming' ELSE {STATUS_SQL} END AS performance
    FROM paired
    """,
)
def motivation_sql(spark, sf_dir):
    return _short_start(op.motivation_sql(_metrics(spark, sf_dir), SHORT, LONG))


@query(
    "pace_status",
    f"""
    WITH {AVERAGES_SQL}
    SELECT status, count(*) AS n
    FROM (SELECT CASE WHEN short_avg = 0 OR long_avg = 0 THEN 'none' ELSE {STATUS_SQL} END AS status
          FROM paired)
    GROUP BY status
    """,
)
def pace_status(spark, sf_dir):
    metrics = _metrics(spark, sf_dir)
    paired = op.short_average(metrics, SHORT).join(
        op.long_average(metrics, SHORT, LONG), ["user", "window_start"]
    )
    status = pace.pace_status(F.col("short_avg"), F.col("long_avg"))
    return paired.groupBy(F.coalesce(status, F.lit("none")).alias("status")).agg(
        F.count("*").alias("n")
    )
