"""Web-log traffic, in DataFrame and in SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import panes


def user_traffic(log: DataFrame) -> DataFrame:
    """Page views and total, largest and smallest response per user."""
    size = F.col("file_size_bytes")
    return log.groupBy("id").agg(
        F.count("*").alias("page_views"),
        F.sum(size).alias("total_bytes"),
        F.max(size).alias("max_bytes"),
        F.min(size).alias("min_bytes"),
    )


def user_traffic_sql(log: DataFrame) -> DataFrame:
    return log.sparkSession.sql(
        """
        SELECT id,
               count(*) AS page_views,
               sum(file_size_bytes) AS total_bytes,
               max(file_size_bytes) AS max_bytes,
               min(file_size_bytes) AS min_bytes
        FROM {log}
        GROUP BY id
        """,
        log=log,
    )


def tumble_count_global(log: DataFrame, width: int = panes.MINUTE, ts: str = "ts") -> DataFrame:
    """Page views per window; windows without any are absent."""
    counts = log.groupBy(panes.tumbling(ts, width)).agg(F.count("*").alias("page_views"))
    return panes.with_bounds(counts)


def tumble_count_sql(log: DataFrame, width: int = panes.MINUTE, ts: str = "ts") -> DataFrame:
    """The same in SQL, with the bounds as strings."""
    return log.sparkSession.sql(
        f"""
        SELECT string(w.start) AS window_start,
               string(w.end) AS window_end,
               page_views
        FROM (
            SELECT window({ts}, '{panes.duration(width)}') AS w, count(*) AS page_views
            FROM {{log}}
            GROUP BY window({ts}, '{panes.duration(width)}')
        )
        """,
        log=log,
    )


def tumble_count_user(
    log: DataFrame, width: int = 20 * panes.SECOND, ts: str = "ts"
) -> DataFrame:
    """Page views per user and window."""
    counts = log.groupBy(panes.tumbling(ts, width), "id").agg(
        F.count("*").alias("page_views")
    )
    return panes.with_bounds(counts)


def tumble_count_user_sql(
    log: DataFrame, width: int = 20 * panes.SECOND, ts: str = "ts"
) -> DataFrame:
    """The same in SQL, with the bounds as strings."""
    return log.sparkSession.sql(
        f"""
        SELECT id AS event_id,
               string(w.start) AS window_start,
               string(w.end) AS window_end,
               page_views
        FROM (
            SELECT id, window({ts}, '{panes.duration(width)}') AS w, count(*) AS page_views
            FROM {{log}}
            GROUP BY id, window({ts}, '{panes.duration(width)}')
        )
        """,
        log=log,
    )
