"""Co-groups and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators import orders as op
from millrace.operators.cogroup import cogroup_parts, cogroup_two
from millrace.plans import panes

LIST_SIZE = 8
CHUNKS = 16

SIDES_SQL = """
    sides AS (
        SELECT o_custkey AS k, 0 AS side, CAST(o_orderkey AS VARCHAR) AS o,
               o_orderkey || ':' || CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders
        UNION ALL
        SELECT s_suppkey, 1, CAST(s_suppkey AS VARCHAR), s_name FROM supplier
    )
"""
LISTS_SQL = """
    count(*) FILTER (side = 0) AS n_left, count(*) FILTER (side = 1) AS n_right,
    coalesce(string_agg(v, '|' ORDER BY v) FILTER (side = 0), '') AS left_values,
    coalesce(string_agg(v, '|' ORDER BY v) FILTER (side = 1), '') AS right_values
"""


def _sides(spark, sf_dir):
    price = t.whole("o_totalprice").cast("string")
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"),
        "o_orderkey",
        F.concat_ws(":", F.col("o_orderkey").cast("string"), price).alias("value"),
    )
    suppliers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), "s_suppkey", F.col("s_name").alias("value")
    ).withColumnRenamed("s_suppkey", "supplier")
    return orders, suppliers


def _lists(both, *columns):
    return both.select(
        *columns,
        F.size("left_values").cast("bigint").alias("n_left"),
        F.size("right_values").cast("bigint").alias("n_right"),
        F.array_join("left_values", "|").alias("left_values"),
        F.array_join("right_values", "|").alias("right_values"),
    )


@query("cogroup_two", f"WITH {SIDES_SQL} SELECT k, {LISTS_SQL} FROM sides GROUP BY k")
def cogrouped(spark, sf_dir):
    return _lists(cogroup_two(*_sides(spark, sf_dir), "k"), "k")


@query(
    "cogroup_parts",
    f"""
    WITH {SIDES_SQL},
    parts AS (
        SELECT *, (row_number() OVER (PARTITION BY k, side ORDER BY o) - 1) // {LIST_SIZE} AS part
        FROM sides
    )
    SELECT k, part, {LISTS_SQL} FROM parts GROUP BY k, part
    """,
)
def cogrouped_in_parts(spark, sf_dir):
    both = cogroup_parts(
        *_sides(spark, sf_dir), "k", ["o_orderkey"], ["supplier"], LIST_SIZE, chunks=CHUNKS
    )
    return _lists(both, "k", "part")


@query(
    "enrich_orders_static",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
              epoch_us(o_orderdate) // 1000000 AS timestamp, c_name, c_mktsegment
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def enrich_orders_static(spark, sf_dir):
    enriched = op.enrich_orders_static(t.orders(spark, sf_dir), t.customers(spark, sf_dir))
    return enriched.select(
        "order_id", "customer_id", F.unix_seconds("ts").alias("timestamp"), "c_name",
        "c_mktsegment",
    )


@query(
    "enrich_orders_refreshed",
    f"""
    WITH seen AS (SELECT *, epoch_us(o_orderdate) // {7 * panes.DAY} AS bucket FROM orders)
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_name,
           CASE WHEN c_custkey IS NOT NULL THEN dense_rank() OVER (ORDER BY bucket) END AS version
    FROM seen LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def enrich_orders_refreshed(spark, sf_dir):
    enriched = op.enrich_orders_refreshed(
        t.orders(spark, sf_dir), t.customers(spark, sf_dir), 7 * panes.DAY
    )
    return enriched.select("order_id", "customer_id", "c_name", "version")
