"""Word queries over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.functions.dates import iso_seconds, rfc3339
from millrace.operators import accumulate, enrich
from millrace.operators import words as op

ASCII_SQL = "regexp_extract_all(text, '[A-Za-z'']+')"
WORDS_SQL = f"SELECT doc_id, unnest({ASCII_SQL}) AS w FROM documents"
# Epoch microseconds of a document's arrival, and one row per word with it.
DOC_US = "doc_id * 500000"
TIMED_SQL = f"SELECT {DOC_US} AS us, unnest({ASCII_SQL}) AS w FROM documents"


def iso_sql(us: str) -> str:
    return f"strftime(make_timestamp(CAST({us} AS BIGINT)), '%Y-%m-%dT%H:%M:%S')"


def with_iso_bounds(df):
    return df.withColumns(
        {c: iso_seconds(F.col(c)) for c in ("window_start", "window_end")}
    )


@query("word_count", f"SELECT w AS word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY w")
def word_count(spark, sf_dir):
    return op.word_count(t.lines(spark, sf_dir))


@query(
    "average_custom",
    "SELECT CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) AS average FROM events",
)
def average_custom(spark, sf_dir):
    return op.average(t.log(spark, sf_dir), F.col("file_size_bytes"))


@query(
    "average_custom_accumulator",
    "SELECT CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) AS average FROM events",
)
def average_custom_accumulator(spark, sf_dir):
    """The same through an accumulator of the user's own."""
    log = t.log(spark, sf_dir)
    return accumulate.accumulated(
        log, [], "file_size_bytes", accumulate.Mean(), DoubleType(), "average"
    )


@query(
    "longest_words_accumulator",
    f"""
    WITH words AS (
        SELECT DISTINCT lang, w FROM (SELECT lang, unnest({ASCII_SQL}) AS w FROM documents)
    ),
    ranked AS (
        SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY length(w) DESC, w) AS r
        FROM words
    )
    SELECT lang, string_agg(w, ',' ORDER BY r) AS words FROM ranked WHERE r <= 5 GROUP BY lang
    """,
)
def longest_words_accumulator(spark, sf_dir):
    """The five longest words of each language, by an accumulator that is no sum."""
    words = op.tokens(t.table(spark, sf_dir, "documents"), keep=["lang"])
    found = accumulate.accumulated(
        words, ["lang"], "word", accumulate.Longest(5), ArrayType(StringType()), "words"
    )
    return found.withColumn("words", F.array_join("words", ","))


@query(
    "average_word_length",
    f"SELECT CAST(sum(length(w)) AS DOUBLE) / count(*) AS avg_len FROM ({WORDS_SQL})",
)
def average_word_length(spark, sf_dir):
    return op.average_word_length(t.lines(spark, sf_dir))


@query(
    "longest_word",
    f"""SELECT w AS word, length(w) AS length FROM ({WORDS_SQL})
        ORDER BY length(w) DESC, w LIMIT 1""",
)
def longest_word(spark, sf_dir):
    longest = op.longest_word(t.lines(spark, sf_dir))
    return longest.withColumn("length", F.col("length").cast("bigint"))


TOP_K_SQL = f"""
    WITH counted AS (
        SELECT us // 10000000 * 10000000 AS s, w, count(*) AS freq
        FROM ({TIMED_SQL}) GROUP BY 1, 2
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY s ORDER BY freq DESC, w) AS rank FROM counted
    )
    SELECT {iso_sql("s")} AS window_start, {iso_sql("s + 10000000")} AS window_end,
           w AS word, freq
    FROM ranked WHERE rank <= 3
"""


@query("top_k_words", TOP_K_SQL)
def top_k_words(spark, sf_dir):
    return with_iso_bounds(op.top_k_words(t.lines(spark, sf_dir)))


TUMBLE_AVG_SQL = f"""
    SELECT {iso_sql("s")} AS window_start, {iso_sql("s + 5000000")} AS window_end,
           CAST(sum(length(w)) AS DOUBLE) / count(*) AS avg_len
    FROM (SELECT us // 5000000 * 5000000 AS s, w FROM ({TIMED_SQL})) GROUP BY s
"""


@query("tumble_avg_word_len", TUMBLE_AVG_SQL)
def tumble_avg_word_len(spark, sf_dir):
    return with_iso_bounds(op.tumble_avg_word_len(t.lines(spark, sf_dir)))


@query(
    "tumble_word_total",
    f"""SELECT {iso_sql("s")} AS window_start, {iso_sql("s + 1000000")} AS window_end,
               count(*) AS word_count
        FROM (SELECT us // 1000000 * 1000000 AS s FROM ({TIMED_SQL})) GROUP BY s""",
)
def tumble_word_total(spark, sf_dir):
    return with_iso_bounds(op.tumble_word_total(t.lines(spark, sf_dir)))


SLIDING_AVG_SQL = f"""
    WITH placed AS (
        SELECT unnest(range(us // 2000000 - 4, us // 2000000 + 1)) * 2000000 AS s, w
        FROM ({TIMED_SQL})
    )
    SELECT {iso_sql("s")} || 'Z' AS window_start, {iso_sql("s + 10000000")} || 'Z' AS window_end,
           CAST(sum(length(w)) AS DOUBLE) / count(*) AS avg_len
    FROM placed GROUP BY s
"""


@query("sliding_avg_word_len", SLIDING_AVG_SQL)
def sliding_avg_word_len(spark, sf_dir):
    averages = op.sliding_avg_word_len(t.lines(spark, sf_dir))
    return averages.withColumns(
        {c: rfc3339(F.col(c)) for c in ("window_start", "window_end")}
    )


ARRIVALS_SQL = f"""
    arrivals AS (
        SELECT conv_id, turn, {t.TURN_TS} AS s, unnest(ws) AS w, unnest(range(len(ws))) AS pos
        FROM (SELECT *, {ASCII_SQL} AS ws FROM conversations)
    )
"""


RUNNING_LONGEST_SQL = f"""
    WITH {ARRIVALS_SQL},
    best AS (
        SELECT conv_id, turn, pos, max(s) OVER so_far AS latest,
               min(lpad(CAST(99999999 - length(w) AS VARCHAR), 8, '0') || w) OVER so_far AS b
        FROM arrivals
        WINDOW so_far AS (ORDER BY conv_id, turn, pos ROWS UNBOUNDED PRECEDING)
    )
    SELECT conv_id, turn, pos, {iso_sql("latest * 1000000")} || 'Z' AS created_at,
           substr(b, 9) AS word
    FROM best
"""


def shown_so_far(so_far):
    return so_far.withColumns(
        {"created_at": rfc3339(F.col("created_at")), "pos": F.col("pos").cast("bigint")}
    )


@query("running_longest_word", RUNNING_LONGEST_SQL)
def running_longest_word(spark, sf_dir, chunks=None):
    turns = t.turns(spark, sf_dir)
    return shown_so_far(op.running_longest_word(turns, ["conv_id", "turn"], chunks=chunks))


RUNNING_AVG_SQL = f"""
    WITH {ARRIVALS_SQL}
    SELECT conv_id, turn, pos, {iso_sql("max(s) OVER so_far * 1000000")} || 'Z' AS created_at,
           CAST(sum(length(w)) OVER so_far AS DOUBLE) / count(*) OVER so_far AS avg_len
    FROM arrivals
    WINDOW so_far AS (ORDER BY conv_id, turn, pos ROWS UNBOUNDED PRECEDING)
"""


@query("running_avg_word_length", RUNNING_AVG_SQL)
def running_avg_word_length(spark, sf_dir, chunks=None):
    turns = t.turns(spark, sf_dir)
    return shown_so_far(op.running_avg_word_length(turns, ["conv_id", "turn"], chunks=chunks))


# Enrichment: one answer per word occurrence.

ENRICH_SQL = f"""
    SELECT conv_id, turn, w AS word, CAST(length(w) AS INTEGER) AS length
    FROM (SELECT conv_id, turn, unnest({ASCII_SQL}) AS w FROM conversations)
"""


def _requests(spark, sf_dir):
    return op.tokens(t.turns(spark, sf_dir), keep=["conv_id", "turn"])


@query("enrich_each", ENRICH_SQL)
def enrich_each(spark, sf_dir):
    return enrich.enrich_each(_requests(spark, sf_dir))


@query("enrich_batch", ENRICH_SQL)
def enrich_batch(spark, sf_dir):
    return enrich.enrich_batch(_requests(spark, sf_dir))


@query("enrich_distinct", ENRICH_SQL)
def enrich_distinct(spark, sf_dir):
    return enrich.enrich_distinct(_requests(spark, sf_dir))


@query("enrich_batch_sized", ENRICH_SQL)
def enrich_batch_sized(spark, sf_dir):
    return enrich.enrich_batch_sized(_requests(spark, sf_dir), batch_size=10)


@query("distinct_requests", f"SELECT DISTINCT w AS word FROM ({WORDS_SQL})")
def distinct_requests(spark, sf_dir):
    return enrich.distinct_requests(op.tokens(t.lines(spark, sf_dir)))
