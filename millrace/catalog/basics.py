"""Projections, filters, maps and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.functions import text as tx
from millrace.functions.dates import dashed_date, iso_seconds
from millrace.functions.parsing import parse_event_log, parse_positions, with_event_time
from millrace.operators import basics as op
from millrace.operators import staff as st
from millrace.operators import words as w

# The segments and ids the staff queries select.
UNWANTED_IDS = ["7", "42", "99", "1024"]
ITEM_NAME = "hot ring"


@query("parse_event_log", t.LOG_SQL)
def parsed_log(spark, sf_dir):
    return parse_event_log(t.log_lines(spark, sf_dir)).drop("_corrupt")


@query(
    "parse_positions",
    """
    SELECT CAST(user_id AS VARCHAR) AS "user", CAST(floor(value) AS INTEGER) AS spot,
           epoch_us(ts) // 1000000 * 1000000 AS ts_us
    FROM events
    """,
)
def parsed_positions(spark, sf_dir):
    events = t.positions(spark, sf_dir)
    fields = [F.col("user"), F.col("spot"), F.unix_seconds("ts")]
    lines = events.select(F.concat_ws("\t", *[f.cast("string") for f in fields]).alias("value"))
    return parse_positions(lines).select("user", "spot", F.unix_micros("ts").alias("ts_us"))


@query(
    "filter_select_optin",
    f"SELECT ip, id, lat, lng, age_bracket FROM ({t.LOG_SQL}) WHERE opted_into_marketing",
)
def optin(spark, sf_dir):
    return op.filter_select_optin(parse_event_log(t.log_lines(spark, sf_dir)))


def _items(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("value"),
    )


@query(
    "sql_filter_eq",
    f"""SELECT p_partkey AS id, p_name AS name, p_retailprice AS value
        FROM part WHERE p_name = '{ITEM_NAME}'""",
)
def sql_filter(spark, sf_dir):
    return op.sql_filter_eq(_items(spark, sf_dir), ITEM_NAME)


@query(
    "add_constant",
    "SELECT p_partkey AS id, p_name AS name, p_retailprice + 1000 AS value FROM part",
)
def add_constant(spark, sf_dir):
    return op.add_constant(_items(spark, sf_dir))


@query(
    "squares_cubes",
    """SELECT p_partkey, CAST(p_size AS BIGINT) AS x, CAST(p_size AS BIGINT) * p_size AS square,
              CAST(p_size AS BIGINT) * p_size * p_size AS cube FROM part""",
)
def squares_cubes(spark, sf_dir):
    sizes = t.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("bigint").alias("x")
    )
    return op.squares_cubes(sizes, "x")


@query("filter_evens", "SELECT p_partkey AS x FROM part WHERE p_partkey % 2 = 0")
def filter_evens(spark, sf_dir):
    return op.filter_evens(
        t.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("x")), "x"
    )


STAFF_LINE = "c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_mktsegment"


@query(
    "split_csv_row",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
              CAST(c_nationkey AS VARCHAR) AS dept_no, c_mktsegment AS dept, 4 AS n
       FROM customer""",
)
def split_csv_row(spark, sf_dir):
    rows = op.split_csv_row(t.staff_lines(spark, sf_dir))
    names = ["id", "name", "dept_no", "dept"]
    fields = [F.get("fields", i).alias(name) for i, name in enumerate(names)]
    return rows.select(*fields, F.size("fields").alias("n"))


@query("split_csv_flat", f"SELECT unnest(string_split({STAFF_LINE}, ',')) AS field FROM customer")
def split_csv_flat(spark, sf_dir):
    return op.split_csv_flat(t.staff_lines(spark, sf_dir))


@query(
    "filter_by_length_side",
    f"""SELECT name, count(*) AS n FROM ({t.STAFF_SQL})
        WHERE length(name) BETWEEN 3 AND 18
          AND id NOT IN ({", ".join(f"'{i}'" for i in UNWANTED_IDS)})
          AND dept = 'BUILDING'
        GROUP BY name""",
)
def filter_by_length_side(spark, sf_dir):
    kept = op.filter_by_length_side(t.staff(spark, sf_dir), UNWANTED_IDS, 3, 18)
    return st.sum_per_key(kept, "BUILDING")


@query(
    "route_names",
    """SELECT CASE WHEN length(p_name) <= 8 THEN 'short_names' ELSE 'long_names' END AS route,
              p_name AS name, count(*) AS n FROM part GROUP BY 1, 2""",
)
def route_names(spark, sf_dir):
    names = t.table(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    outputs = op.routed(op.route_names(names, cutoff=8))
    tagged = [df.withColumn("route", F.lit(route)) for route, df in outputs.items()]
    union = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return union.groupBy("route", "name").agg(F.count("*").alias("n"))


@query(
    "to_upper_words",
    r"""SELECT upper(replace(w, 'ß', 'ss')) AS word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM documents)
        GROUP BY 1""",
)
def to_upper_words(spark, sf_dir):
    return w.upper_word_count(t.lines(spark, sf_dir))


def _tokens_sql(pattern: str) -> str:
    return f"""
        SELECT conv_id, turn, unnest(ws) AS word,
               unnest(range(len(ws))) AS pos
        FROM (SELECT conv_id, turn, regexp_extract_all(text, '{pattern}') AS ws
              FROM conversations)
    """


def _tokens(spark, sf_dir, pattern):
    placed = w.placed_tokens(
        t.turns(spark, sf_dir), pattern=pattern, keep=["conv_id", "turn"]
    )
    return placed.withColumn("pos", F.col("pos").cast("bigint"))


@query("tokenize_ascii", _tokens_sql("[A-Za-z'']+"))
def tokenize_ascii(spark, sf_dir):
    return _tokens(spark, sf_dir, tx.ASCII_WORD)


@query("tokenize_unicode", _tokens_sql(r"[\p{L}\p{N}_'']+"))
def tokenize_unicode(spark, sf_dir):
    return _tokens(spark, sf_dir, tx.UNICODE_WORD)


@query(
    "format_result",
    r"""SELECT w || ': ' || count(*) AS value
        FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_'']+')) AS w FROM documents)
        GROUP BY w""",
)
def format_result(spark, sf_dir):
    counts = w.word_count(t.lines(spark, sf_dir), pattern=tx.UNICODE_WORD)
    return w.formatted_counts(counts)


@query(
    "normalise_datetime",
    """SELECT CAST(user_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_datetime
       FROM events""",
)
def normalise_datetime(spark, sf_dir):
    log = parse_event_log(t.log_lines(spark, sf_dir))
    return op.normalise_datetime(log).select("id", "event_datetime")


@query(
    "scalar_strings",
    """SELECT p_partkey, trim(' ' || p_name || ' ') AS trimmed, upper(p_name) AS upper_name,
              length(p_name) AS name_length, p_brand || '/' || p_type AS joined,
              string_split(p_name, ' ')[1] AS first_word,
              replace(p_name, 'o', '') AS without_o,
              replace(p_name, '/r/n', '') AS unchanged
       FROM part""",
)
def scalar_strings(spark, sf_dir):
    name = F.col("p_name")
    return t.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit(" "), name, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("upper_name"),
        F.length(name).cast("bigint").alias("name_length"),
        F.concat_ws("/", "p_brand", "p_type").alias("joined"),
        F.get(F.split(name, " "), 0).alias("first_word"),
        tx.remove_literal(name, "o").alias("without_o"),
        tx.remove_literal(name, "/r/n").alias("unchanged"),
    )


@query(
    "scalar_dates",
    """SELECT o_orderkey, month(o_orderdate) AS month_number,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
              strftime(o_orderdate, '%Y-%m-%d') AS parsed_date
       FROM orders""",
)
def scalar_dates(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders")
    dashed = F.date_format(t.utc("o_orderdate"), "dd-MM-yyyy")
    parsed = dashed_date(dashed)
    return orders.select(
        "o_orderkey",
        F.month(parsed).cast("bigint").alias("month_number"),
        iso_seconds(t.utc("o_orderdate")).alias("iso"),
        F.date_format(parsed, "yyyy-MM-dd").alias("parsed_date"),
    )


@query(
    "first_letter_bucket",
    """SELECT ascii(w) % 10 AS bucket, count(*) AS n
       FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS w FROM documents)
       GROUP BY 1""",
)
def first_letter_bucket(spark, sf_dir):
    words = w.tokens(t.lines(spark, sf_dir))
    bucket = tx.first_letter_bucket(F.col("word"))
    return words.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "event_times",
    """SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 * 1000 AS ts_us FROM events""",
)
def event_times(spark, sf_dir):
    log = with_event_time(parse_event_log(t.log_lines(spark, sf_dir)))
    return log.select("id", F.unix_micros("ts").alias("ts_us"))
