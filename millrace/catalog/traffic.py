"""Web-log traffic over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.catalog.words import iso_sql, with_iso_bounds
from millrace.operators import late
from millrace.operators import traffic as op
from millrace.plans import ordered, panes

BYTES_SQL = "CAST(round(value * 100) AS BIGINT)"
USER_TRAFFIC_SQL = f"""
    SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS page_views,
           CAST(sum({BYTES_SQL}) AS BIGINT) AS total_bytes,
           max({BYTES_SQL}) AS max_bytes, min({BYTES_SQL}) AS min_bytes
    FROM events GROUP BY user_id
"""


def hourly_sql(select: str, bounds: str, group: str = "") -> str:
    return f"""
        SELECT {select} {bounds} count(*) AS page_views
        FROM (SELECT *, epoch_us(ts) // {panes.HOUR} * {panes.HOUR} AS s FROM events)
        GROUP BY s{group}
    """


ISO_BOUNDS = f"""{iso_sql("s")} AS window_start,
                 {iso_sql(f"s + {panes.HOUR}")} AS window_end,"""
STRING_BOUNDS = ISO_BOUNDS.replace("%dT%H", "%d %H")


@query("user_traffic", USER_TRAFFIC_SQL)
def user_traffic(spark, sf_dir):
    return op.user_traffic(t.log(spark, sf_dir))


@query("user_traffic_sql", USER_TRAFFIC_SQL)
def user_traffic_sql(spark, sf_dir):
    return op.user_traffic_sql(t.log(spark, sf_dir))


@query("tumble_count_global", hourly_sql("", ISO_BOUNDS))
def tumble_count_global(spark, sf_dir):
    return with_iso_bounds(op.tumble_count_global(t.log(spark, sf_dir), panes.HOUR))


@query("tumble_count_sql", hourly_sql("", STRING_BOUNDS))
def tumble_count_sql(spark, sf_dir):
    return op.tumble_count_sql(t.log(spark, sf_dir), panes.HOUR)


@query("tumble_count_user", hourly_sql("CAST(user_id AS VARCHAR) AS id,", ISO_BOUNDS, ", user_id"))
def tumble_count_user(spark, sf_dir):
    return with_iso_bounds(op.tumble_count_user(t.log(spark, sf_dir), panes.HOUR))


@query(
    "tumble_count_user_sql",
    hourly_sql("CAST(user_id AS VARCHAR) AS event_id,", STRING_BOUNDS, ", user_id"),
)
def tumble_count_user_sql(spark, sf_dir):
    return op.tumble_count_user_sql(t.log(spark, sf_dir), panes.HOUR)


LATE_ORDER = "event_id + event_id * 37 % 50"


@query(
    "split_late",
    f"""
    WITH met AS (
        SELECT event_id, epoch_us(ts) // {panes.HOUR} * {panes.HOUR} AS s,
               max(epoch_us(ts)) OVER (ORDER BY {LATE_ORDER}, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
        FROM events
    )
    SELECT event_id, {ISO_BOUNDS}
           coalesce(watermark >= s + {panes.HOUR} + {30 * panes.MINUTE}, false) AS droppable
    FROM met
    """,
)
def split_late(spark, sf_dir, chunks=None):
    events = t.table(spark, sf_dir, "events")
    arrivals = events.select(
        "event_id", t.utc("ts").alias("ts"), F.expr(LATE_ORDER).alias("arrival")
    )
    tagged = late.split_late(
        arrivals,
        ["arrival", "event_id"],
        panes.HOUR,
        lateness=30 * panes.MINUTE,
        chunks=chunks,
    )
    return with_iso_bounds(tagged.drop("ts", "arrival"))


@query(
    "running_global",
    """
    SELECT event_id, row_number() OVER so_far AS seq,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER so_far AS BIGINT) AS bytes_so_far,
           max(CAST(round(value * 100) AS BIGINT)) OVER so_far AS largest_so_far
    FROM events WINDOW so_far AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)
    """,
)
def running_global(spark, sf_dir, chunks=None):
    size = F.round(F.col("value") * 100).cast("bigint")
    events = t.table(spark, sf_dir, "events").select("event_id", size.alias("size"))
    so_far = ordered.running(
        ordered.chunked(events, ["event_id"], chunks=chunks),
        {
            "seq": ordered.fold_count(),
            "bytes_so_far": ordered.fold_sum(F.col("size")),
            "largest_so_far": ordered.fold_max(F.col("size")),
        },
    )
    return so_far.select("event_id", "seq", "bytes_so_far", "largest_so_far")
