"""Co-groups, sales, orders and late rows."""

import random

import pytest
from rows import tuples
from pyspark.sql import functions as F

from millrace.operators import late, orders, sales
from millrace.operators.cogroup import cogroup_parts, cogroup_two
from millrace.plans import panes

SECOND = panes.SECOND


def sides(spark):
    left = [("hot", f"l{i:04d}", i) for i in range(3000)] + [("a", "x", 1), ("a", "x", 2)]
    right = [("a", "y", 1), ("b", "z", 1), ("hot", "r", 1)]
    schema = "k STRING, value STRING, o INT"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)


def test_cogroup_rows(spark):
    left, right = sides(spark)
    both = cogroup_two(left, right, "k")
    found = {r.k: (r.left_values, r.right_values) for r in both.collect()}
    assert found["a"] == (["x", "x"], ["y"])
    assert found["b"] == ([], ["z"])
    assert len(found["hot"][0]) == 3000 and found["hot"][1] == ["r"]


@pytest.mark.parametrize("chunks", [4, 32])
def test_hot_cogroup_key_is_split_and_whole(spark, chunks):
    left, right = sides(spark)
    both = cogroup_parts(left, right, "k", ["o"], ["o"], 100, chunks=chunks).collect()
    hot = [r for r in both if r.k == "hot"]
    assert sorted(r.part for r in hot) == list(range(30))
    assert all(len(r.left_values) == 100 for r in hot)
    assert sorted(v for r in hot for v in r.left_values) == [f"l{i:04d}" for i in range(3000)]
    assert [r.part for r in both if r.k == "a"] == [0]


def profits(spark, at, rows):
    data = [(city, at(s), p, i) for i, (city, s, p) in enumerate(rows)]
    return spark.createDataFrame(data, "city STRING, ts TIMESTAMP, profit BIGINT, seq BIGINT")


def test_profit_by_row(spark):
    rows = [("Oslo", 7, 2, 6), ("Turin", 4, 5, 5), ("Quito", 2, 8, 3)]
    df = spark.createDataFrame(rows, "city STRING, pieces INT, buy_rate INT, sell_price INT")
    kept = sales.profit_by_row(df, ["Oslo", "Quito"])
    assert tuples(kept, "city", "profit") == [("Oslo", 28), ("Quito", -10)]
    assert sales.profit_by_row(df).count() == 3


def test_sessions(spark, at):
    rows = [("a", 0, 1), ("a", 4, 2), ("a", 9, 4), ("a", 15, 8), ("b", 2, 16), ("a", 19.9, 32)]
    table = profits(spark, at, rows)
    shown = ("city", F.unix_seconds("window_start"), F.unix_seconds("window_end"), "profit")
    assert tuples(sales.session_profit(table, 5 * SECOND), *shown) == [
        ("a", 0, 14, 7), ("a", 15, 24, 40), ("b", 2, 7, 16),
    ]
    apart = sales.session_profit(table, 5 * SECOND, merge_touching=False)
    assert tuples(apart, *shown)[:2] == [("a", 0, 9, 3), ("a", 9, 14, 4)]


def test_sessions_equal_built_in(spark, at):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), rng.randrange(4000) / 2, rng.randrange(9)) for _ in range(400)]
    table = profits(spark, at, rows)
    built_in = table.groupBy(F.session_window("ts", "5 seconds").alias("window"), "city").agg(
        F.sum("profit").alias("profit")
    )
    columns = ("city", "window_start", "window_end", "profit")
    ours = sales.session_profit(table, 5 * SECOND)
    assert tuples(ours, *columns) == tuples(panes.with_bounds(built_in), *columns)


def test_profit_windows(spark, at):
    table = profits(spark, at, [("a", 1, 1), ("a", 4, 2), ("a", 11, 4)])
    start = F.unix_seconds("window_start")
    tumbling = sales.tumble_profit(table, 10 * SECOND)
    assert tuples(tumbling, start, "profit") == [(0, 3), (10, 4)]
    sliding = sales.sliding_profit(table, 6 * SECOND, 3 * SECOND)
    assert tuples(sliding, start, "profit") == [(-3, 1), (0, 3), (3, 2), (6, 4), (9, 4)]


def test_count_panes(spark, at):
    rows = [("a", 0, i) for i in range(12)] + [("b", 0, 100)] * 5
    panes_shown = sales.global_count_discarding(profits(spark, at, rows), ["seq"])
    assert tuples(panes_shown, "city", "pane", "sales", "profit") == [
        ("a", 0, 5, 10), ("a", 1, 5, 35), ("a", 2, 2, 21), ("b", 0, 5, 500),
    ]


def test_count_panes_of_a_hot_city(spark, at):
    rows = [("hot", i, 1) for i in range(4000)]
    shown = sales.global_count_discarding(profits(spark, at, rows), ["seq"], chunks=16)
    assert tuples(shown, "pane", "sales") == [(i, 5) for i in range(800)]


def order_tables(spark, at):
    rows = [(1, 10, at(0)), (2, 11, at(4)), (3, 99, at(5)), (4, 10, at(21))]
    table = spark.createDataFrame(rows, "order_id INT, customer_id INT, ts TIMESTAMP")
    return table, spark.createDataFrame([(10, "x"), (11, "y")], "customer_id INT, name STRING")


def test_unknown_customers_stay(spark, at):
    enriched = orders.enrich_orders_static(*order_tables(spark, at))
    rows = {r.order_id: r.name for r in enriched.collect()}
    assert rows == {1: "x", 2: "y", 3: None, 4: "x"}


def test_lookup_versions(spark, at):
    enriched = orders.enrich_orders_refreshed(*order_tables(spark, at), 5 * SECOND)
    rows = {r.order_id: (r.name, r.version) for r in enriched.collect()}
    # Buckets 0, 5 and 20 were seen; order 3 moved the lookup on but found nobody.
    assert rows == {1: ("x", 1), 2: ("y", 1), 3: (None, None), 4: ("x", 3)}


def test_late_rows_by_given_watermark(spark, at):
    rows = [("a", at(3), 0), ("b", at(4), 6_999_000), ("c", at(0), 7_000_000)]
    table = spark.createDataFrame(rows, "w STRING, ts TIMESTAMP, wm BIGINT")
    main, droppable = late.outputs(
        late.split_late(table, [], 5 * SECOND, 2 * SECOND, watermark="wm")
    )
    start, end = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    assert tuples(main, "w", start, end) == [("a", 0, 5), ("b", 0, 5)]
    assert tuples(droppable, "w") == [("c",)]


def test_late_row_may_be_first_of_its_window(spark, at):
    table = spark.createDataFrame([("c", at(0), 7_500_000)], "w STRING, ts TIMESTAMP, wm BIGINT")
    tagged = late.split_late(table, [], 5 * SECOND, 2 * SECOND, watermark="wm")
    assert tagged.head().droppable


@pytest.mark.parametrize("chunks", [8, 1000])
def test_late_rows_by_arrival(spark, at, chunks):
    rng = random.Random(2)
    rows = [(i, at(i - rng.randrange(12))) for i in range(800)]
    table = spark.createDataFrame(rows, "seq BIGINT, ts TIMESTAMP")
    tagged = late.split_late(
        table, ["seq"], 5 * SECOND, 2 * SECOND, delay=SECOND, chunks=chunks
    )
    seen, expected = None, []
    for i, ts in rows:
        s = ts.timestamp()
        expected.append((i, seen is not None and seen - 1 >= s - s % 5 + 5 + 2))
        seen = s if seen is None else max(seen, s)
    assert tuples(tagged, "seq", "droppable") == expected
    assert any(flag for _, flag in expected)


@pytest.mark.parametrize("merge_touching", [True, False])
@pytest.mark.parametrize("chunks", [None, 16])
def test_sessions_over_cuts(spark, at, merge_touching, chunks):
    """One city with most rows; sessions shorter and much longer than a chunk."""
    rng = random.Random(21)
    times = {"hot": [], "a": [], None: []}
    clock = 0
    while len(times["hot"]) < 900:
        gap = rng.choice([1, 2, 5, 5, 6, 30]) if clock < 1500 or clock > 3000 else rng.choice([1, 5])
        clock += gap
        times["hot"].append(clock)
    times["a"] = [0, 5, 10, 16, 16, 21]
    times[None] = [3, 9]
    rows = [(city, at(s), rng.randrange(-9, 90)) for city, some in times.items() for s in some]
    sold = spark.createDataFrame(rows, "city STRING, ts TIMESTAMP, profit BIGINT").repartition(5)
    expected = []
    for city in times:
        own = sorted((ts.timestamp(), p) for c, ts, p in rows if c == city)
        opened = []
        for second, p in own:
            apart = second - opened[-1][1] if opened else None
            if apart is None or apart > 5 or (apart == 5 and not merge_touching):
                opened.append([second, second, p])
            else:
                opened[-1][1:] = [second, opened[-1][2] + p]
        expected += [(city or "-", int(a), int(b) + 5, p) for a, b, p in opened]
    found = sales.session_profit(sold, 5 * panes.SECOND, merge_touching=merge_touching, chunks=chunks)
    start, end = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    assert tuples(found, F.coalesce("city", F.lit("-")), start, end, "profit") == sorted(expected)
