"""Structured Streaming forms: each reads its tables as a stream and runs it dry."""

from __future__ import annotations

from itertools import count

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import oracle_sql, query
from millrace.catalog.sales import ARRIVAL, TUMBLE_PROFIT_SQL
from millrace.catalog.sources import MESSAGES_SQL, as_messages
from millrace.catalog.tracking import LONG, METRICS_SQL, MOTIVATION_SQL, SHORT, STEPS_SQL
from millrace.catalog.traffic import ISO_BOUNDS, LATE_ORDER
from millrace.catalog.words import (
    ASCII_SQL,
    RUNNING_AVG_SQL,
    RUNNING_LONGEST_SQL,
    SLIDING_AVG_SQL,
    TOP_K_SQL,
    TUMBLE_AVG_SQL,
    WORDS_SQL,
    iso_sql,
    shown_so_far,
    with_iso_bounds,
)
from millrace.functions.dates import iso_seconds, rfc3339
from millrace.operators import sales as sale
from millrace.operators import traffic
from millrace.operators import words as bounded
from millrace.plans import panes
from millrace.plans.shared import shared_folder
from millrace.sources import messages
from millrace.streaming import enrich, late, runs, tracking
from millrace.streaming import sales as stream_sales
from millrace.streaming import words as stream_words

HOUR = panes.HOUR
TOP_K_BATCH_BYTES = 128 * 1024 * 1024


# Every input comes in four micro-batches in order of time.  Where windows are shown once,
# when the watermark has passed them, a last row a month later stands for the end.


def _lines(spark, sf_dir, closed=False, batch_bytes=None):
    closing = ("doc_id", lambda last: F.lit(last + 10_000_000)) if closed else None
    documents = t.table_stream(spark, sf_dir, "documents", F.col("doc_id"), closing, batch_bytes)
    return t.as_lines(documents)


def _events(spark, sf_dir, closed=False):
    later = lambda last: F.timestamp_micros(F.lit(last + 30 * panes.DAY))
    by = F.unix_micros(t.utc("ts"))
    return t.table_stream(spark, sf_dir, "events", by, ("ts", later) if closed else None)


def _orders(spark, sf_dir):
    return t.as_orders(t.table_stream(spark, sf_dir, "orders", F.unix_seconds(t.utc("o_orderdate"))))


VIEWS_SQL = f"""
    SELECT CAST(user_id AS VARCHAR) AS id, {ISO_BOUNDS} count(*) AS page_views
    FROM (SELECT *, epoch_us(ts) // {HOUR} * {HOUR} AS s FROM events)
    GROUP BY user_id, s
"""


@query("stream_tumble_count_user", VIEWS_SQL)
def stream_tumble_count_user(spark, sf_dir):
    log = t.as_log(_events(spark, sf_dir, closed=True)).withWatermark("ts", "10 minutes")
    closed = runs.emitted(traffic.tumble_count_user(log, HOUR))
    return with_iso_bounds(closed.drop(runs.BATCH))


@query("stream_tumble_count_user_sql", VIEWS_SQL.replace(" AS id", " AS event_id").replace("%dT%H", "%d %H"))
def stream_tumble_count_user_sql(spark, sf_dir):
    log = t.as_log(_events(spark, sf_dir, closed=True)).withWatermark("ts", "10 minutes")
    return runs.emitted(traffic.tumble_count_user_sql(log, HOUR)).drop(runs.BATCH)


@query("stream_message_sink", MESSAGES_SQL)
def stream_message_sink(spark, sf_dir):
    """Counts of closed windows sent as messages; every second batch is sent twice."""
    log = t.as_log(_events(spark, sf_dir, closed=True)).withWatermark("ts", "10 minutes")
    counts = with_iso_bounds(traffic.tumble_count_user(log, HOUR))
    folder = shared_folder(spark, "sent")
    topic = messages.MessageLog(f"{folder}/topic")

    def twice(batch, batch_id):
        if batch_id % 2:
            topic.append(batch, batch_id)
            topic(batch, batch_id)
        topic(batch, batch_id)

    runs.drain(as_messages(counts), twice, f"{folder}/checkpoint")
    received = topic.received(spark)
    return received.select(F.col("key").cast("string"), F.col("value").cast("string"))


ARRIVED_SQL = t.batch_sql(LATE_ORDER, "events")


@query(
    "stream_split_late",
    f"""
    WITH arrived AS (SELECT *, {ARRIVED_SQL} AS batch FROM events),
    seen AS (
        SELECT batch, max(max(epoch_us(ts))) OVER (
                   ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
        FROM arrived GROUP BY batch
    )
    SELECT event_id, batch AS batch_id,
           coalesce(watermark >= epoch_us(ts) // {HOUR} * {HOUR} + {HOUR} + {30 * panes.MINUTE},
                    false) AS droppable
    FROM arrived JOIN seen USING (batch)
    """,
)
def stream_split_late(spark, sf_dir):
    """Arrivals out of the order of their times; a batch meets the times of those before."""
    events = t.table_stream(spark, sf_dir, "events", F.expr(LATE_ORDER))
    arrivals = events.select("event_id", t.utc("ts").alias("ts"))
    folder = shared_folder(spark, "late")
    target = late.LateSplit(
        f"{folder}/state",
        HOUR,
        30 * panes.MINUTE,
        main=runs.into_batches(f"{folder}/main"),
        droppable=runs.into_batches(f"{folder}/droppable"),
    )
    runs.drain(arrivals, target, f"{folder}/checkpoint")
    sides = [
        runs.read_batches(spark, f"{folder}/{side}", arrivals).withColumn("droppable", F.lit(flag))
        for side, flag in (("main", False), ("droppable", True))
    ]
    return sides[0].unionByName(sides[1]).select(
        "event_id", F.col(runs.BATCH).alias("batch_id"), "droppable"
    )


@query("tumble_profit_triggered", TUMBLE_PROFIT_SQL)
def tumble_profit_triggered(spark, sf_dir):
    """Update mode: a window's sum is shown again whenever it changed."""
    by = F.unix_seconds(t.utc("l_shipdate"))
    sold = t.as_sales(t.table_stream(spark, sf_dir, "lineitem", by))
    profits = sale.profit_by_row(t.with_city(sold, spark, sf_dir))
    sums = sale.tumble_profit(profits.withWatermark("ts", "2 days"), 10 * panes.DAY)
    shown = runs.emitted(sums, "update")
    return with_iso_bounds(runs.latest(shown, ["city", "window_start", "window_end"]))


@query("unwindowed_count", f"SELECT w AS word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY w")
def unwindowed_count(spark, sf_dir):
    shown = runs.emitted(stream_words.unwindowed_count(_lines(spark, sf_dir)), "complete")
    return runs.latest(shown, ["word"])


@query("stream_tumble_avg_word_len", TUMBLE_AVG_SQL)
def stream_tumble_avg_word_len(spark, sf_dir):
    averages = bounded.tumble_avg_word_len(_lines(spark, sf_dir).withWatermark("ts", "1 second"))
    shown = runs.emitted(averages, "update")
    return with_iso_bounds(runs.latest(shown, ["window_start", "window_end"]))


@query("stream_sliding_avg_word_len", SLIDING_AVG_SQL)
def stream_sliding_avg_word_len(spark, sf_dir):
    averages = bounded.sliding_avg_word_len(_lines(spark, sf_dir).withWatermark("ts", "1 second"))
    shown = runs.latest(runs.emitted(averages, "update"), ["window_start", "window_end"])
    return shown.withColumns({c: rfc3339(F.col(c)) for c in ("window_start", "window_end")})


@query("stream_top_k_words", TOP_K_SQL)
def stream_top_k_words(spark, sf_dir):
    """Micro-batches of bounded size, as the state has a row per word of their windows."""
    lines = _lines(spark, sf_dir, closed=True, batch_bytes=TOP_K_BATCH_BYTES)
    counts = stream_words.word_window_counts(lines, 10 * panes.SECOND, delay="1 second")
    folder = shared_folder(spark, "top-k")
    sink = stream_words.top_k_sink(3, runs.into_batches(f"{folder}/out"))
    runs.drain(counts, sink, f"{folder}/checkpoint")
    shape = panes.with_bounds(counts).select("window_start", "window_end", "word", "freq")
    best = runs.read_batches(spark, f"{folder}/out", shape)
    return with_iso_bounds(best.drop(runs.BATCH))


@query(
    "stream_count_discarding",
    f"""SELECT {t.batch_sql("doc_id", "documents")} AS batch_id, w AS word, count(*) AS n
        FROM ({WORDS_SQL}) GROUP BY 1, 2""",
)
def stream_count_discarding(spark, sf_dir):
    """Each firing forgets what it showed: a pane of every batch for each of its words."""
    words = bounded.tokens(_lines(spark, sf_dir))
    folder = shared_folder(spark, "discarding")
    sink = stream_words.discarding_count_sink(runs.into_batches(f"{folder}/out"), "word")
    runs.drain(words, sink, f"{folder}/checkpoint")
    shape = words.withColumn("n", F.lit(0).cast("bigint"))
    shown = runs.read_batches(spark, f"{folder}/out", shape)
    return shown.select(F.col(runs.BATCH).alias("batch_id"), "word", "n")


@query(
    "stream_running_longest_word",
    f"""SELECT w AS word, (SELECT {iso_sql("max(doc_id * 500000)")} FROM documents) AS created_at
        FROM ({WORDS_SQL}) ORDER BY length(w) DESC, w LIMIT 1""",
)
def stream_running_longest_word(spark, sf_dir):
    best = stream_words.running_longest_word(_lines(spark, sf_dir))
    shown = runs.latest(runs.emitted(best, "update"), [])
    return shown.withColumn("created_at", iso_seconds(F.col("created_at")))


@query(
    "stream_running_avg_word_length",
    f"""SELECT CAST(sum(length(w)) AS DOUBLE) / count(*) AS avg_len,
               (SELECT {iso_sql("max(doc_id * 500000)")} FROM documents) AS created_at
        FROM ({WORDS_SQL})""",
)
def stream_running_avg_word_length(spark, sf_dir):
    mean = stream_words.running_avg_word_length(_lines(spark, sf_dir))
    shown = runs.latest(runs.emitted(mean, "update"), [])
    return shown.withColumn("created_at", iso_seconds(F.col("created_at")))


def _each_word(spark, sf_dir, result):
    """A row per word of the conversations, which come in order of their ids."""
    by = F.col("conv_id")
    turns = t.as_turns(t.table_stream(spark, sf_dir, "conversations", by))
    folder = shared_folder(spark, "each-word")
    order = ["conv_id", "turn"]
    target = stream_words.RunningWords(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), order, result
    )
    runs.drain(turns, target, f"{folder}/checkpoint")
    shape = result[0](t.turns(spark, sf_dir), order, chunks=1)
    return shown_so_far(runs.read_batches(spark, f"{folder}/out", shape).drop(runs.BATCH))


@query("stream_running_longest_word_each", RUNNING_LONGEST_SQL)
def stream_running_longest_word_each(spark, sf_dir):
    return _each_word(spark, sf_dir, stream_words.RunningWords.LONGEST)


@query("stream_running_avg_word_length_each", RUNNING_AVG_SQL)
def stream_running_avg_word_length_each(spark, sf_dir):
    return _each_word(spark, sf_dir, stream_words.RunningWords.AVERAGE)


@query("stream_global_count_discarding", oracle_sql()["global_count_discarding"])
def stream_global_count_discarding(spark, sf_dir):
    """Panes of five sales per city, and those that the end leaves unfinished."""
    by = F.unix_seconds(t.utc("l_shipdate"))
    sold = t.as_sales(t.table_stream(spark, sf_dir, "lineitem", by))
    profits = sale.profit_by_row(t.with_city(sold, spark, sf_dir)).select("city", *ARRIVAL)
    folder = shared_folder(spark, "count-panes")
    target = stream_sales.CountPanes(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), ARRIVAL
    )
    runs.drain(profits, target, f"{folder}/checkpoint")
    closing = target.closing(spark, profits)
    return runs.read_batches(spark, f"{folder}/out", closing).drop(runs.BATCH).unionByName(closing)


# Sales that arrive up to twelve days off the order of their days.
SALES_ARRIVAL = "{seconds} + (l_orderkey * 7919 % 25 - 12) * 86400"
ARRIVED_SALES_SQL = t.batch_sql(
    SALES_ARRIVAL.format(seconds="epoch_us(l_shipdate) // 1000000"), "lineitem"
)


@query(
    "tumble_profit_panes",
    f"""
    WITH arrived AS (
        SELECT l_suppkey, epoch_us(l_shipdate) AS us, {ARRIVED_SALES_SQL} AS batch,
               (CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT)
                - CAST(floor(l_extendedprice * (1 - l_tax)) AS BIGINT))
               * CAST(l_quantity AS INTEGER) AS profit
        FROM lineitem
    ),
    seen AS (
        SELECT batch, max(max(us)) OVER (
                   ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
        FROM arrived GROUP BY batch
    ),
    placed AS (
        SELECT n_name AS city, us // {10 * panes.DAY} * {10 * panes.DAY} AS s, batch, watermark,
               sum(profit) AS added
        FROM arrived JOIN seen USING (batch)
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY 1, 2, 3, 4
    ),
    fired AS (
        SELECT *, coalesce(watermark >= s + {10 * panes.DAY}, false) AS closed
        FROM placed
        WHERE NOT coalesce(watermark >= s + {12 * panes.DAY}, false)
    )
    SELECT city, {iso_sql("s")} AS window_start, {iso_sql(f"s + {10 * panes.DAY}")} AS window_end,
           batch AS batch_id, row_number() OVER w - 1 AS pane,
           CASE WHEN NOT closed THEN 'early'
                WHEN sum(CASE WHEN closed THEN 1 ELSE 0 END) OVER w = 1 THEN 'on time'
                ELSE 'late' END AS timing,
           CAST(sum(added) OVER w AS BIGINT) AS profit
    FROM fired WINDOW w AS (PARTITION BY city, s ORDER BY batch ROWS UNBOUNDED PRECEDING)
    """,
)
def tumble_profit_panes(spark, sf_dir):
    """Every firing of each window: its number, its timing and the sum so far."""
    by = F.expr(SALES_ARRIVAL.format(seconds="unix_seconds(CAST(l_shipdate AS TIMESTAMP))"))
    sold = t.as_sales(t.table_stream(spark, sf_dir, "lineitem", by))
    profits = sale.profit_by_row(t.with_city(sold, spark, sf_dir)).select("city", "ts", "profit")
    folder = shared_folder(spark, "profit-panes")
    target = stream_sales.AccumulatingPanes(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), 10 * panes.DAY, 2 * panes.DAY
    )
    runs.drain(profits, target, f"{folder}/checkpoint")
    shown = runs.read_batches(spark, f"{folder}/out", target.shape(profits))
    return with_iso_bounds(shown)


def _metrics_folder(spark, sf_dir, keep_pauses=False):
    """Positions as a stream, turned into metrics in a folder."""
    positions = t.as_positions(_events(spark, sf_dir))
    folder = shared_folder(spark, "metrics")
    target = tracking.BoxedMetrics(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), "event_id", keep_pauses
    )
    runs.drain(positions, target, f"{folder}/checkpoint")
    return f"{folder}/out"


METRICS = f"user BIGINT, ts TIMESTAMP, distance BIGINT, duration BIGINT, {runs.BATCH} BIGINT"


def _metrics_stream(spark, sf_dir, keep_pauses=False):
    folder = _metrics_folder(spark, sf_dir, keep_pauses)
    reader = spark.readStream.schema(METRICS).option("basePath", folder)
    return reader.parquet(f"{folder}/{runs.BATCH}=*").drop(runs.BATCH)


@query(
    "stream_boxed_metrics",
    f"""WITH {METRICS_SQL} SELECT "user", us AS ts_us, distance, duration FROM metrics""",
)
def stream_boxed_metrics(spark, sf_dir):
    folder = _metrics_folder(spark, sf_dir)
    metrics = spark.read.schema(METRICS).option("basePath", folder).parquet(folder)
    return metrics.select("user", F.unix_micros("ts").alias("ts_us"), "distance", "duration")


@query(
    "stream_boxed_metrics_shuffled",
    f"""WITH {METRICS_SQL} SELECT "user", us AS ts_us, distance, duration FROM metrics""",
)
def stream_boxed_metrics_shuffled(spark, sf_dir):
    """Arrivals out of the order of their times, put in order by the watermark."""
    later = lambda last: F.timestamp_micros(F.unix_micros(F.lit("2030-01-01").cast("timestamp")))
    events = t.table_stream(spark, sf_dir, "events", F.expr(LATE_ORDER), ("ts", later))
    folder = shared_folder(spark, "metrics-shuffled")
    target = tracking.BoxedMetrics(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), "event_id", delay=2 * panes.DAY
    )
    runs.drain(t.as_positions(events), target, f"{folder}/checkpoint")
    metrics = spark.read.schema(METRICS).option("basePath", f"{folder}/out").parquet(f"{folder}/out")
    return metrics.select("user", F.unix_micros("ts").alias("ts_us"), "distance", "duration")


@query(
    "stream_running_track_speed",
    f"""WITH {STEPS_SQL}
        SELECT "user", CASE WHEN coalesce(sum(duration), 0) = 0 THEN 0.0
                    ELSE CAST(sum(distance) AS DOUBLE) * 1e6 / sum(duration) END AS speed
        FROM steps GROUP BY "user" """,
)
def stream_running_track_speed(spark, sf_dir):
    speeds = tracking.running_track_speed(_metrics_stream(spark, sf_dir, keep_pauses=True))
    return runs.latest(runs.emitted(speeds, "update"), ["user"])


@query("stream_motivation", MOTIVATION_SQL)
def stream_motivation(spark, sf_dir):
    statuses = tracking.motivation(_metrics_stream(spark, sf_dir), SHORT, LONG, "1 hour")
    shown = runs.latest(runs.emitted(statuses, "update"), ["user", "window_end"])
    start = panes.from_micros(panes.micros(F.col("window_end")) - SHORT)
    return shown.select("user", iso_seconds(start).alias("window_start"), "status")


@query(
    "periodic_orders",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
              epoch_us(o_orderdate) // 1000000 AS timestamp FROM orders""",
)
def periodic_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return runs.emitted(enrich.periodic(orders)).drop(runs.BATCH)


@query(
    "periodic_orders_fired",
    """SELECT order_id, customer_id, firing, 1000 + firing * 5 AS timestamp
       FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                    (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 5 AS firing
             FROM orders)""",
)
def periodic_orders_fired(spark, sf_dir):
    """Five orders per firing, a firing every five seconds."""
    orders = _orders(spark, sf_dir)
    folder = shared_folder(spark, "fired")
    seconds = F.unix_seconds("ts").alias("seconds")
    target = enrich.PeriodicFirings(
        f"{folder}/state", runs.into_batches(f"{folder}/out"), ["seconds", "order_id"], start=1000
    )
    runs.drain(orders.select("order_id", "customer_id", seconds), target, f"{folder}/checkpoint")
    out = f"{folder}/out"
    shown = spark.read.option("basePath", out).parquet(f"{out}/{runs.BATCH}=*")
    return shown.drop(runs.BATCH)


@query(
    "stream_enrich_batch_sized",
    f"""SELECT word, s * 1000000 AS ts_us, CAST(length(word) AS INTEGER) AS length
        FROM (SELECT {t.TURN_TS} AS s, unnest({ASCII_SQL}) AS word FROM conversations)""",
)
def stream_enrich_batch_sized(spark, sf_dir):
    """Calls of ten words; a timer answers those that wait."""
    turns = t.as_turns(t.table_stream(spark, sf_dir, "conversations", F.col("conv_id")))
    words = bounded.tokens(turns, keep=["ts"])
    answered = enrich.enrich_batch_sized(words, batch_size=10, max_wait_secs=1)
    folder = shared_folder(spark, "sized")
    runs.settle(answered, runs.into_batches(f"{folder}/out"), f"{folder}/checkpoint")
    shown = runs.read_batches(spark, f"{folder}/out", answered)
    return shown.select("word", F.unix_micros("ts").alias("ts_us"), "length")


ORDERED_SQL = t.batch_sql("epoch_us(o_orderdate) // 1000000", "orders")


@query(
    "stream_enrich_orders_refreshed",
    f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_name,
               CASE WHEN c_custkey IS NOT NULL
                    THEN CAST({ORDERED_SQL} * 4 // 5 + 1 AS INTEGER) END AS version
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def stream_enrich_orders_refreshed(spark, sf_dir):
    """Four seconds pass between batches, so all but the second get a new version."""
    orders = _orders(spark, sf_dir).drop("ts")
    clock = count(0, 4)
    folder = shared_folder(spark, "refreshed")
    target = enrich.RefreshedLookup(
        f"{folder}/state",
        load=lambda session, version: t.customers(session, sf_dir),
        max_stale_sec=5,
        sink=runs.into_batches(f"{folder}/out"),
        clock=lambda: next(clock),
    )
    runs.drain(orders, target, f"{folder}/checkpoint")
    out = f"{folder}/out"
    shown = spark.read.option("basePath", out).parquet(f"{out}/{runs.BATCH}=*")
    return shown.select("order_id", "customer_id", "c_name", "version")
