"""Store sales over lineitem, supplier and nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.catalog.words import iso_sql, with_iso_bounds
from millrace.operators import sales as op
from millrace.plans import panes

CITIES = ["NATION_3", "NATION_7"]
DAY = panes.DAY
ARRIVAL = ["unix_timestamp", "order_id", "line", "product_id", "store_id", "profit"]


def _profits(spark, sf_dir):
    return op.profit_by_row(t.sales(spark, sf_dir))


@query(
    "profit_by_row",
    f"""WITH {t.SALES_SQL}
        SELECT store_id, city, product_id, CAST(profit AS BIGINT) AS profit FROM sales
        WHERE city IN ('NATION_3', 'NATION_7')""",
)
def profit_by_row(spark, sf_dir):
    profits = op.profit_by_row(t.sales(spark, sf_dir), CITIES)
    return profits.select("store_id", "city", "product_id", "profit")


TUMBLE_PROFIT_SQL = f"""
    WITH {t.SALES_SQL}
    SELECT city, {iso_sql("s")} AS window_start, {iso_sql(f"s + {10 * DAY}")} AS window_end,
           CAST(sum(profit) AS BIGINT) AS profit
    FROM (SELECT *, us // {10 * DAY} * {10 * DAY} AS s FROM sales) GROUP BY city, s
"""


@query("tumble_profit", TUMBLE_PROFIT_SQL)
def tumble_profit(spark, sf_dir):
    return with_iso_bounds(op.tumble_profit(_profits(spark, sf_dir), 10 * DAY))


@query(
    "sliding_profit",
    f"""
    WITH {t.SALES_SQL}
    SELECT city, {iso_sql("s")} AS window_start, {iso_sql(f"s + {6 * DAY}")} AS window_end,
           CAST(sum(profit) AS BIGINT) AS profit
    FROM (SELECT *, unnest(range(us // {3 * DAY} - 1, us // {3 * DAY} + 1)) * {3 * DAY} AS s
          FROM sales)
    GROUP BY city, s
    """,
)
def sliding_profit(spark, sf_dir):
    return with_iso_bounds(op.sliding_profit(_profits(spark, sf_dir), 6 * DAY, 3 * DAY))


@query(
    "session_profit",
    f"""
    WITH {t.SALES_SQL},
    marked AS (
        SELECT store_id, us, profit,
               CASE WHEN us - lag(us) OVER w <= {5 * DAY} THEN 0 ELSE 1 END AS opens
        FROM sales WINDOW w AS (PARTITION BY store_id ORDER BY us)
    ),
    numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY store_id ORDER BY us
                                   RANGE UNBOUNDED PRECEDING) AS session
        FROM marked
    )
    SELECT store_id, {iso_sql("min(us)")} AS window_start,
           {iso_sql(f"max(us) + {5 * DAY}")} AS window_end, CAST(sum(profit) AS BIGINT) AS profit
    FROM numbered GROUP BY store_id, session
    """,
)
def session_profit(spark, sf_dir, chunks=None):
    sessions = op.session_profit(_profits(spark, sf_dir), 5 * DAY, key="store_id", chunks=chunks)
    return with_iso_bounds(sessions)


@query(
    "session_profit_hot",
    f"""
    WITH {t.SALES_SQL},
    placed AS (
        SELECT CASE WHEN order_id % 5 = 0 THEN city ELSE 'elsewhere' END AS city, profit,
               us // {DAY} * {DAY} + order_id % 17 * 60000000 AS us
        FROM sales
    ),
    marked AS (
        SELECT *, CASE WHEN us - lag(us) OVER w <= 90000000 THEN 0 ELSE 1 END AS opens
        FROM placed WINDOW w AS (PARTITION BY city ORDER BY us)
    ),
    numbered AS (
        SELECT *, sum(opens) OVER (PARTITION BY city ORDER BY us
                                   RANGE UNBOUNDED PRECEDING) AS session
        FROM marked
    )
    SELECT city, {iso_sql("min(us)")} AS window_start,
           {iso_sql("max(us) + 90000000")} AS window_end, CAST(sum(profit) AS BIGINT) AS profit
    FROM numbered GROUP BY city, session
    """,
)
def session_profit_hot(spark, sf_dir):
    """Four fifths of the sales in one city, and its order cut into sixteen chunks."""
    day, minute = panes.DAY, panes.MINUTE
    at = panes.floor_to(panes.micros(F.col("ts")), day) + F.col("order_id") % 17 * minute
    city = F.when(F.col("order_id") % 5 == 0, F.col("city")).otherwise("elsewhere")
    profits = _profits(spark, sf_dir).select(
        city.alias("city"), panes.from_micros(at).alias("ts"), "profit"
    )
    return with_iso_bounds(op.session_profit(profits, 90 * panes.SECOND, chunks=16))


@query(
    "global_count_discarding",
    f"""
    WITH {t.SALES_SQL},
    numbered AS (
        SELECT *, (row_number() OVER (PARTITION BY city
                   ORDER BY us, order_id, line, product_id, store_id, profit) - 1) // 5 AS pane
        FROM sales
    )
    SELECT city, pane, count(*) AS sales, CAST(sum(profit) AS BIGINT) AS profit
    FROM numbered GROUP BY city, pane
    """,
)
def global_count_discarding(spark, sf_dir):
    return op.global_count_discarding(arrivals(spark, sf_dir), ARRIVAL)


def arrivals(spark, sf_dir):
    return _profits(spark, sf_dir).select("city", *ARRIVAL)


@query(
    "profit_messages",
    f"""WITH {t.SALES_SQL}
        SELECT city || ',' || CAST(sum(profit) AS BIGINT) AS value FROM sales GROUP BY city""",
)
def profit_messages(spark, sf_dir):
    totals = _profits(spark, sf_dir).groupBy("city").agg(F.sum("profit").alias("profit"))
    return totals.select(F.concat_ws(",", "city", F.col("profit").cast("string")).alias("value"))
