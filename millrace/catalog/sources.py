"""Sources and sinks, over files that Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.catalog.traffic import tumble_count_user
from millrace.functions.parsing import EVENT_LOG_JSON, parse_event_log
from millrace.operators import words as w
from millrace.plans.shared import date_files, shared_folder
from millrace.sources import files, messages
from millrace.sources.values import from_values
from millrace.streaming.runs import drain, emitted, into_batches, read_batches

# Weight of each event type.
WEIGHTS = [("click", 1), ("view", 2), ("signup", 3), ("purchase", 5)]


@query("read_text", r"SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def read_text(spark, sf_dir):
    folder = shared_folder(spark, "read-text")
    files.write_text(t.lines(spark, sf_dir).select("text"), folder)
    return files.read_text(spark, folder)


@query(
    "read_delimited",
    f"SELECT id, name, dept_no, dept, count(*) AS visits FROM ({t.STAFF_SQL}) GROUP BY ALL",
)
def read_delimited(spark, sf_dir):
    folder = shared_folder(spark, "read-delimited")
    t.staff(spark, sf_dir).write.option("header", True).csv(folder)
    staff = files.read_delimited(spark, folder, files.STAFF, header=True)
    return staff.groupBy("id", "name", "dept_no", "dept").agg(F.count("*").alias("visits"))


@query(
    "write_text",
    """SELECT w || ': ' || count(*) AS value
       FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS w FROM documents)
       GROUP BY w""",
)
def write_text(spark, sf_dir):
    folder = shared_folder(spark, "write-text")
    files.write_text(w.formatted_counts(w.word_count(t.lines(spark, sf_dir))), folder)
    return files.read_text(spark, folder)


@query(
    "from_values",
    """SELECT event_type, count(*) AS events, CAST(sum(weight) AS BIGINT) AS total
       FROM events JOIN (VALUES ('click', 1), ('view', 2), ('signup', 3), ('purchase', 5))
            AS given(event_type, weight) USING (event_type)
       GROUP BY event_type""",
)
def values(spark, sf_dir):
    given = from_values(spark, WEIGHTS, "event_type STRING, weight INT")
    joined = t.table(spark, sf_dir, "events").join(F.broadcast(given), "event_type")
    return joined.groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum("weight").alias("total")
    )


LINES_SQL = r"""
    SELECT doc_id AS name, length(b) - length(replace(b, chr(10), ''))
           + CASE WHEN b <> '' AND NOT ends_with(b, chr(10)) THEN 1 ELSE 0 END AS n
    FROM (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS b
          FROM documents)
"""


@query("list_file_lines", f"SELECT name, unnest(range(n)) AS position FROM ({LINES_SQL})")
def list_file_lines(spark, sf_dir):
    ranges = files.text_ranges(t.lines(spark, sf_dir), "doc_id", "text")
    return files.positions(ranges)


@query(
    "file_ranges",
    """SELECT source, unnest(range(CAST(sum(len(string_split(text, chr(10)))) AS BIGINT))) AS position
       FROM documents GROUP BY source""",
)
def file_ranges(spark, sf_dir):
    """A file per source, all of a folder of their own."""
    folder = shared_folder(spark, "file-ranges")
    texts = t.table(spark, sf_dir, "documents").select("source", "text")
    texts.repartition("source").write.partitionBy("source").text(folder)
    source = F.regexp_extract("path", "source=([^/]+)", 1).alias("source")
    return files.list_file_lines(spark, folder).select(source, "position")


@query(
    "watch_directory",
    """SELECT source, count(*) AS lines
       FROM (SELECT source, unnest(string_split(text, chr(10))) FROM documents)
       GROUP BY source""",
)
def watch_directory(spark, sf_dir):
    folder = shared_folder(spark, "watched")
    documents = t.table(spark, sf_dir, "documents").select("source", "text")
    documents.write.partitionBy("source").text(folder)
    lines = files.watch_directory(spark, f"{folder}/source=*")
    seen = emitted(lines.select("path", "ts"))
    source = F.regexp_extract("path", "/source=([^/]+)/", 1)
    return seen.groupBy(source.alias("source")).agg(F.count("*").alias("lines"))


WATCHED_FROM = 1_700_000_000  # a full minute


@query(
    "watch_directory_arrivals",
    f"""
    WITH placed AS (
        SELECT source, dense_rank() OVER (ORDER BY source) - 1 AS nth, text FROM documents
    ),
    lines AS (SELECT source, nth, unnest(string_split(text, chr(10))) FROM placed)
    SELECT source, {WATCHED_FROM} // 60 * 60 + nth * 60 AS minute, count(*) AS lines
    FROM lines GROUP BY source, nth
    """,
)
def watch_directory_arrivals(spark, sf_dir):
    """Files that come between triggers, a minute apart, and are counted when it is over.

    The stream is stopped before each file and started again after it: its checkpoint
    knows the files it has read.  A last file far later moves the watermark past all others.
    """
    folder = shared_folder(spark, "arriving")
    documents = t.table(spark, sf_dir, "documents").select("source", "text")
    names = [r.source for r in documents.select("source").distinct().orderBy("source").collect()]
    minute = F.window("ts", "1 minute")

    def arrive(name, at, texts):
        place = f"{folder}/in/source={name}"
        texts.write.text(place)
        date_files(spark, place, at * 1000)
        lines = files.watch_directory(spark, f"{folder}/in/source=*").withWatermark("ts", "0 seconds")
        source = F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source")
        counts = lines.groupBy(minute, source).agg(F.count("*").alias("lines"))
        drain(counts, into_batches(f"{folder}/out"), f"{folder}/checkpoint")
        return counts

    for nth, name in enumerate(names):
        texts = documents.where(F.col("source") == name).select("text")
        arrive(name, WATCHED_FROM // 60 * 60 + nth * 60, texts)
    counts = arrive("end", WATCHED_FROM * 2, spark.range(1).select(F.lit("").alias("text")))
    shown = read_batches(spark, f"{folder}/out", counts)
    return shown.select("source", F.unix_seconds("window.start").alias("minute"), "lines")


def _message_folder(spark, sf_dir):
    folder = shared_folder(spark, "messages")
    log = t.log_lines(spark, sf_dir)
    empty = F.lit("").cast("binary").alias("key")
    log.select(empty, F.col("value").cast("binary"), "timestamp").write.parquet(folder)
    return folder


@query(
    "message_source",
    f"SELECT id, event_datetime, event_ts, file_size_bytes, lat, lng FROM ({t.LOG_SQL})",
)
def message_source(spark, sf_dir):
    stream = messages.read_message_files(spark, _message_folder(spark, sf_dir))
    log = parse_event_log(messages.decoded(stream))
    return emitted(log.drop("_corrupt")).select(
        "id", "event_datetime", "event_ts", "file_size_bytes", "lat", "lng"
    )


@query(
    "message_passthrough",
    f"""SELECT '{{"event_id":"' || id || '","event_ts":' || event_ts || '}}' AS key,
               id, event_datetime, lat, lng, opted_into_marketing
        FROM ({t.LOG_SQL})""",
)
def message_passthrough(spark, sf_dir):
    stream = messages.read_message_files(spark, _message_folder(spark, sf_dir))
    sent = emitted(messages.passthrough(parse_event_log(messages.decoded(stream))))
    received = sent.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), EVENT_LOG_JSON).alias("log"),
    )
    log = [F.col(f"log.{c}") for c in ("id", "event_datetime", "opted_into_marketing")]
    place = [F.col(f"log.{c}").cast("double").alias(c) for c in ("lat", "lng")]
    return received.select("key", *log, *place)


MESSAGES_SQL = """
    SELECT '{"event_id":"' || id || '","window_start":"' || s || '"}' AS key,
           '{"id":"' || id || '","window_start":"' || s || '","page_views":' || n || '}' AS value
    FROM (SELECT CAST(user_id AS VARCHAR) AS id,
                 strftime(make_timestamp(epoch_us(ts) // 3600000000 * 3600000000),
                          '%Y-%m-%dT%H:%M:%S') AS s,
                 count(*) AS n
          FROM events GROUP BY 1, 2)
"""


def as_messages(counts):
    return messages.to_messages(
        counts,
        ["id", "window_start", "page_views"],
        {"event_id": "id", "window_start": "window_start"},
    )


@query("message_sink", MESSAGES_SQL)
def message_sink(spark, sf_dir):
    sent = as_messages(tumble_count_user(spark, sf_dir))
    folder = shared_folder(spark, "sink")
    sent.write.parquet(folder)
    received = spark.read.parquet(folder)
    return received.select(F.col("key").cast("string"), F.col("value").cast("string"))
