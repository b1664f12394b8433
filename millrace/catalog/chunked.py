"""Ordered operators with their order cut into chunks, whatever the tables' size.

The default number of chunks follows the rows, so small tables have one.  These queries
must give the same rows as those without ``chunks``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import sales as sale
from millrace.catalog import tables as t
from millrace.catalog import traffic, words
from millrace.catalog.registry import oracle_sql, query
from millrace.operators import sales, tracking
from millrace.operators import words as word_operators

CHUNKS = 16
SQL = oracle_sql()


@query("running_global_chunked", SQL["running_global"])
def running_global_chunked(spark, sf_dir):
    return traffic.running_global(spark, sf_dir, CHUNKS)


@query("split_late_chunked", SQL["split_late"])
def split_late_chunked(spark, sf_dir):
    return traffic.split_late(spark, sf_dir, CHUNKS)


@query("track_speed_chunked", SQL["track_speed"])
def track_speed_chunked(spark, sf_dir):
    return tracking.track_speed(t.positions(spark, sf_dir), "event_id", CHUNKS)


@query("running_track_speed_chunked", SQL["running_track_speed"])
def running_track_speed_chunked(spark, sf_dir):
    speeds = tracking.running_track_speed(t.positions(spark, sf_dir), "event_id", CHUNKS)
    return speeds.select("user", "event_id", F.unix_micros("ts").alias("ts_us"), "speed")


@query("global_count_discarding_chunked", SQL["global_count_discarding"])
def global_count_discarding_chunked(spark, sf_dir):
    profits = sale.arrivals(spark, sf_dir)
    return sales.global_count_discarding(profits, sale.ARRIVAL, chunks=CHUNKS)


@query("session_profit_chunked", SQL["session_profit"])
def session_profit_chunked(spark, sf_dir):
    return sale.session_profit(spark, sf_dir, CHUNKS)


@query("running_longest_word_chunked", SQL["running_longest_word"])
def running_longest_word_chunked(spark, sf_dir):
    return words.running_longest_word(spark, sf_dir, CHUNKS)


@query("running_avg_word_length_chunked", SQL["running_avg_word_length"])
def running_avg_word_length_chunked(spark, sf_dir):
    return words.running_avg_word_length(spark, sf_dir, CHUNKS)


@query(
    "running_avg_word_length_documents",
    """
    WITH arrivals AS (
        SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z'']+') AS ws FROM documents)
    )
    SELECT doc_id, pos,
           CAST(sum(length(w)) OVER so_far AS DOUBLE) / count(*) OVER so_far AS avg_len
    FROM arrivals WINDOW so_far AS (ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING)
    """,
)
def running_avg_word_length_documents(spark, sf_dir):
    """Documents of up to 20,000 words, the long ones cut inside."""
    so_far = word_operators.running_avg_word_length(t.lines(spark, sf_dir), ["doc_id"], chunks=CHUNKS)
    return so_far.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "avg_len")
