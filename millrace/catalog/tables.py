"""Benchmark tables as the operators' inputs.

Money and measures become integers on the way in, so that sums are exact and do not
depend on the order in which partitions are added up.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.shared import date_files, file_names, shared_folder
from millrace.plans.sizing import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCHES = 4
# Values in one file of a stream's input, at most about this much; a file per core, though,
# unless they would be tiny.
FILE_BYTES = 4 * 1024 * 1024
TINY_BYTES = 1024 * 1024
PLACE, CELL = "_place", "_cell"


def batch_of(by: Column, low: int, high: int, batches: int = BATCHES) -> Column:
    """The micro-batch of a value: equal ranges of it in order."""
    return F.floor((by - low) * batches / (high - low + 1)).cast("int")


def batch_sql(by: str, table: str) -> str:
    """The same in SQL, over the whole table."""
    return f"""(({by}) - (SELECT min({by}) FROM {table})) * {BATCHES}
               // ((SELECT max({by}) - min({by}) + 1 FROM {table}))"""


def _value_bytes(rows: DataFrame) -> Column:
    """Size of a row's values: strings by their bytes, others at eight."""
    strings = [f.name for f in rows.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.octet_length(name), F.lit(0)).cast("bigint") for name in strings]
    return reduce(lambda a, b: a + b, sizes, F.lit(8 * len(rows.columns)).cast("bigint"))


def _files(size: int, cores: int) -> int:
    """Files for a micro-batch of ``size`` bytes."""
    return max(1, -(-size // FILE_BYTES), min(cores, size // TINY_BYTES))


def table_stream(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    by: Column,
    closing: tuple[str, Callable[[int], Column]] | None = None,
    batch_bytes: int | None = None,
) -> DataFrame:
    """The table as a stream of four micro-batches, in order of an integer ``by``.

    ``closing`` adds a last row that has nothing but a time, in a column made from the
    largest ``by``: it moves the watermark past every window, as the end of a bounded
    input does.  With ``batch_bytes`` there are more micro-batches where four would be
    larger than that.

    Each micro-batch has the same number of files, which follows the bytes of the largest.
    One pass writes them all, a task per file; their dates tell the order.
    """
    rows = table(spark, sf_dir, name)
    size = _value_bytes(rows)
    low, high, total = rows.agg(F.min(by), F.max(by), F.sum(size)).first()
    batches = max(BATCHES, -(-(total or 0) // batch_bytes)) if batch_bytes else BATCHES
    placed = rows.withColumn(PLACE, batch_of(by, low, high, batches)).where(F.col(PLACE).isNotNull())
    of_batch = placed.groupBy(PLACE).agg(F.sum(size).alias("size"))
    files = _files(of_batch.agg(F.max("size")).first()[0] or 0, spark.sparkContext.defaultParallelism)
    folder = shared_folder(spark, f"input-{name}")
    cell = F.col(PLACE) * files + F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
    cells = placed.withColumn(CELL, cell).repartitionById(batches * files, F.col(CELL))
    cells.drop(CELL).write.partitionBy(PLACE).parquet(folder)
    places = [f"{folder}/{PLACE}={batch}" for batch in range(batches)]
    for place in places:
        found = sum(f.endswith(".parquet") for f in file_names(spark, place))
        for _ in range(files - found):
            spark.createDataFrame([], rows.schema).write.mode("append").parquet(place)
    if closing is not None:
        column, after = closing
        last = [
            (after(high) if f.name == column else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in rows.schema
        ]
        places.append(f"{folder}/{PLACE}={batches}")
        spark.range(1).select(*last).write.parquet(places[-1])
    now = int(time.time() * 1000)
    for i, place in enumerate(places):
        date_files(spark, place, now + (i - len(places)) * 1000)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/{PLACE}=*")


def utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def whole(column: str) -> Column:
    return F.floor(column).cast("bigint")


# Words.  A document arrives every half second, a turn within its conversation's
# minute and not in order of its turn.


def as_lines(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id", "text", F.timestamp_millis(F.col("doc_id") * 500).alias("ts")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(as_lines(table(spark, sf_dir, "documents")))


def as_turns(conversations: DataFrame) -> DataFrame:
    seconds = F.col("conv_id") * 60 + (F.col("turn") * 37) % 60
    return conversations.select(
        "conv_id", "turn", "text", F.timestamp_seconds(seconds).alias("ts")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_turns(table(spark, sf_dir, "conversations"))


TURN_TS = "conv_id * 60 + (turn * 37) % 60"


# Web log.


def as_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        utc("ts").alias("ts"),
        F.round(F.col("value") * 100).cast("bigint").alias("file_size_bytes"),
        "event_type",
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log(table(spark, sf_dir, "events"))


def as_log_lines(events: DataFrame) -> DataFrame:
    """The events as JSON web-log lines; some have an empty lng, some a lat of 0."""
    user = F.col("user_id")
    error = F.col("event_type") == "error"
    bracket = F.when(user % 3 == 0, "18-25").when(user % 3 == 1, "26-40").otherwise("41-55")
    line = F.struct(
        F.concat(F.lit("10.0.0."), user.cast("string")).alias("ip"),
        user.cast("string").alias("id"),
        F.get_json_object("props", "$.k").cast("int").alias("lat"),
        F.when(error, "").otherwise((user % 90).cast("string")).alias("lng"),
        F.concat(F.lit("agent/"), F.col("event_type")).alias("user_agent"),
        bracket.alias("age_bracket"),
        (user % 2 == 0).alias("opted_into_marketing"),
        F.concat(F.lit("GET /"), F.col("event_type")).alias("http_request"),
        F.when(error, 500).otherwise(200).alias("http_response"),
        F.round(F.col("value") * 100).cast("int").alias("file_size_bytes"),
        F.date_format(utc("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("event_datetime"),
        F.unix_millis(utc("ts")).alias("event_ts"),
    )
    return events.select(F.to_json(line).alias("value"), utc("ts").alias("timestamp"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log_lines(table(spark, sf_dir, "events"))


LOG_SQL = """
    SELECT '10.0.0.' || user_id AS ip,
           CAST(user_id AS VARCHAR) AS id,
           CAST(CASE WHEN no_place THEN -1 ELSE k END AS DOUBLE) AS lat,
           CAST(CASE WHEN no_place THEN -1 ELSE user_id % 90 END AS DOUBLE) AS lng,
           'agent/' || event_type AS user_agent,
           CASE user_id % 3 WHEN 0 THEN '18-25' WHEN 1 THEN '26-40' ELSE '41-55' END AS age_bracket,
           user_id % 2 = 0 AS opted_into_marketing,
           'GET /' || event_type AS http_request,
           CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_response,
           CAST(round(value * 100) AS INTEGER) AS file_size_bytes,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS event_datetime,
           epoch_us(ts) // 1000 AS event_ts
    FROM (
        SELECT *, event_type = 'error' OR k = 0 OR user_id % 90 = 0 AS no_place
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
    )
"""


# Positions.


def as_positions(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("user"), whole("value").alias("spot"), utc("ts").alias("ts"),
        "event_id",
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_positions(table(spark, sf_dir, "events"))


# Staff attendance: a visit per order of a customer.


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    visits = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    joined = visits.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("dept_no"),
        F.col("c_mktsegment").alias("dept"),
        F.date_format(utc("o_orderdate"), "dd-MM-yyyy").alias("date"),
    )


STAFF_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_nationkey AS dept_no,
           c_mktsegment AS dept
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def staff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c).cast("string") for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]
    return table(spark, sf_dir, "customer").select(F.concat_ws(",", *fields).alias("value"))


# Bank: a statement and a loan payment per order.


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = whole("l_extendedprice")
    cleared = F.when(F.col("l_linestatus") == "F", price).otherwise(0)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(price).alias("billed"),
            F.sum(cleared).alias("cleared"),
            F.max("l_shipdate").alias("due"),
        )
    )


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    per_order = _order_lines(spark, sf_dir)
    return orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).withColumns(
        {
            "customer_id": F.col("o_custkey").cast("string"),
            "first_name": F.lit("Customer"),
            "last_name": F.col("o_custkey").cast("string"),
        }
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = whole("o_totalprice")
    spent = F.least(limit, F.col("billed"))
    return _customer_orders(spark, sf_dir).select(
        "customer_id",
        "first_name",
        "last_name",
        limit.alias("max_limit"),
        spent.alias("spent"),
        F.least(spent, F.col("cleared")).alias("payment_cleared"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    medical = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return _customer_orders(spark, sf_dir).select(
        "customer_id",
        "first_name",
        "last_name",
        F.when(medical, " Medical Loan").otherwise("Personal Loan ").alias("loan_type"),
        F.date_format(utc("due"), "dd-MM-yyyy ").alias("due_date"),
        F.date_format(utc("o_orderdate"), " dd-MM-yyyy").alias("payment_date"),
    )


BANK_SQL = """
    per_order AS (
        SELECT l_orderkey,
               sum(CAST(floor(l_extendedprice) AS BIGINT)) AS billed,
               sum(CASE WHEN l_linestatus = 'F'
                        THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE 0 END) AS cleared,
               max(l_shipdate) AS due
        FROM lineitem GROUP BY l_orderkey
    ),
    cards AS (
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
               o_custkey || ', Customer ' || o_custkey AS name,
               CAST(floor(o_totalprice) AS BIGINT) AS max_limit,
               least(CAST(floor(o_totalprice) AS BIGINT), billed) AS spent,
               least(CAST(floor(o_totalprice) AS BIGINT), billed, cleared) AS payment_cleared
        FROM orders JOIN per_order ON o_orderkey = l_orderkey
    ),
    card_defaulters AS (
        SELECT customer_id, name,
               CAST(sum(
                   CASE WHEN payment_cleared < spent * CAST(0.7 AS DOUBLE) THEN 1 ELSE 0 END
                   + CASE WHEN spent = max_limit AND payment_cleared < spent THEN 1 ELSE 0 END
                   + CASE WHEN spent = max_limit
                               AND payment_cleared < spent * CAST(0.7 AS DOUBLE)
                          THEN 1 ELSE 0 END) AS BIGINT) AS points
        FROM cards GROUP BY customer_id, name HAVING points > 0
    ),
    loans AS (
        SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
               o_custkey || ', Customer ' || o_custkey AS name,
               o_orderpriority IN ('1-URGENT', '2-HIGH') AS medical,
               due, o_orderdate AS paid, month(o_orderdate) AS m
        FROM orders JOIN per_order ON o_orderkey = l_orderkey
    ),
    medical AS (
        SELECT customer_id, name, CAST(sum(CASE WHEN paid > due THEN 1 ELSE 0 END) AS BIGINT) AS missed
        FROM loans WHERE medical GROUP BY customer_id, name HAVING missed >= 3
    ),
    months AS (
        SELECT customer_id, name, m,
               lead(m, 1, 13) OVER w - m - 1 AS gap_after,
               row_number() OVER w AS nth
        FROM loans WHERE NOT medical
        WINDOW w AS (PARTITION BY customer_id, name ORDER BY m)
    ),
    personal_all AS (
        SELECT customer_id, name, count(*) AS payments,
               greatest(max(gap_after), min(m) - 1) AS gap
        FROM months GROUP BY customer_id, name
    ),
    personal AS (
        SELECT customer_id, name,
               CAST(CASE WHEN 12 - payments > 4 THEN 12 - payments ELSE gap END AS BIGINT) AS missed
        FROM personal_all WHERE 12 - payments > 4 OR gap > 2
    )
"""


# Store sales.  The day of shipping is the time of the sale.


def as_sales(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice")
    return lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("int").alias("pieces"),
        F.floor(price * (1 - F.col("l_discount"))).cast("bigint").alias("sell_price"),
        F.floor(price * (1 - F.col("l_tax"))).cast("bigint").alias("buy_rate"),
        F.unix_seconds(utc("l_shipdate")).alias("unix_timestamp"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        utc("l_shipdate").alias("ts"),
    )


def with_city(sales: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with their store's city.

    The joins are left-deep on plain scans, whose sizes the planner knows; for a join
    of two small tables it assumes the product of their sizes.
    """
    stores = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return sales.join(stores, "store_id").join(nations, "n_nationkey").drop("n_nationkey")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_city(as_sales(table(spark, sf_dir, "lineitem")), spark, sf_dir)


SALES_SQL = """
    sales AS (
        SELECT l_suppkey AS store_id, n_name AS city, l_partkey AS product_id,
               l_orderkey AS order_id, l_linenumber AS line,
               epoch_us(l_shipdate) AS us,
               (CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT)
                - CAST(floor(l_extendedprice * (1 - l_tax)) AS BIGINT))
               * CAST(l_quantity AS INTEGER) AS profit
        FROM lineitem
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
    )
"""


# Orders and the customer lookup.


def as_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        utc("o_orderdate").alias("ts"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_orders(table(spark, sf_dir, "orders"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name", "c_mktsegment"
    )
