"""Chunked prefixes against plain windows."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.plans import ordered


def make(spark, rows=6000, seed=5):
    """A third of all rows belongs to one key."""
    rng = random.Random(seed)
    data = [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(300)}", rng.randrange(900), i,
         rng.randrange(-50, 50))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "k STRING, us BIGINT, id BIGINT, v BIGINT")


def folds():
    return {
        "total": ordered.fold_sum(F.col("v")),
        "n": ordered.fold_count(),
        "highest": ordered.fold_max(F.col("v")),
        "lowest": ordered.fold_min(F.col("v")),
    }


def expected(df, window):
    return df.select(
        "id",
        F.sum("v").over(window).alias("total"),
        F.sum(F.lit(1).cast("bigint")).over(window).alias("n"),
        F.max("v").over(window).alias("highest"),
        F.min("v").over(window).alias("lowest"),
    )


def same(left, right):
    return sorted(map(tuple, left.collect()), key=str) == sorted(
        map(tuple, right.collect()), key=str
    )


@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_running_equals_window(spark, keys, current):
    df = make(spark)
    parts = ordered.chunked(df, ["us", "id"], keys=keys, chunks=8)
    assert len(parts.cuts) == 7
    ours = ordered.running(parts, folds(), include_current=current)
    by = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("us", "id")
    frame = by.rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    assert same(ours.select("id", *folds()), expected(df, frame))


def test_previous_equals_lag(spark):
    df = make(spark)
    parts = ordered.chunked(df, ["us", "id"], keys=["k"], chunks=16)
    ours = ordered.previous(parts, ["v", "us"]).select("id", "prev_v", "prev_us")
    by = Window.partitionBy("k").orderBy("us", "id")
    plain = df.select("id", F.lag("v").over(by), F.lag("us").over(by))
    assert same(ours, plain)


def test_previous_value_may_be_null(spark):
    df = make(spark).withColumn("v", F.expr("nullif(v % 3, 0)"))
    parts = ordered.chunked(df, ["us", "id"], keys=["k"], chunks=16)
    ours = ordered.previous(parts, ["v"]).select("id", "prev_v")
    by = Window.partitionBy("k").orderBy("us", "id")
    assert same(ours, df.select("id", F.lag("v").over(by)))


def test_hot_key_spans_many_even_chunks(spark):
    df = make(spark, rows=20000)
    parts = ordered.chunked(df, ["us", "id"], keys=["k"], chunks=32)
    sizes = [r["count"] for r in parts.rows.groupBy("k", ordered.CHUNK).count().collect()]
    assert max(sizes) < 3 * 20000 / 32
    hot = parts.rows.where("k = 'hot'").select(ordered.CHUNK).distinct().count()
    assert hot >= 9


def test_one_repeated_time_still_splits(spark):
    df = spark.range(20000).select(F.lit(7).cast("bigint").alias("us"), "id")
    parts = ordered.chunked(df, ["us", "id"], chunks=16)
    assert parts.rows.select(ordered.CHUNK).distinct().count() == 16
    last = ordered.running(parts, {"n": ordered.fold_count()}).agg(F.max("n")).head()[0]
    assert last == 20000


def test_small_input_is_one_chunk(spark):
    df = make(spark, rows=20)
    parts = ordered.chunked(df, ["us", "id"], chunks=8)
    assert parts.cuts == []
    assert ordered.running(parts, {"n": ordered.fold_count()}).agg(F.max("n")).head()[0] == 20


def test_chunks_follow_the_rows_not_the_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    counts = []
    for width in ("2", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        for rows in (4_000, 40_000):
            df = spark.range(rows).select("id")
            counts.append(len(ordered.chunked(df, ["id"], rows_per_chunk=1000).cuts))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert counts[:2] == counts[2:] and counts[1] > 30 and 2 <= counts[0] <= 6


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_nulls_and_repeated_values(spark, keys):
    some = "nullif(us % 7, 3)"
    df = make(spark, 3000).selectExpr("nullif(k, 'hot') AS k", f"{some} AS us", "id", "v")
    df = df.unionByName(df.where("id < 600").selectExpr("k", "us", "id + 10000 AS id", "v"))
    parts = ordered.chunked(df, ["us", "id"], keys=keys, rows_per_chunk=200)
    assert parts.cuts
    ours = ordered.running(parts, folds())
    by = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("us", "id")
    frame = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert same(ours.select("id", *folds()), expected(df, frame))


def test_empty_input(spark):
    df = make(spark, rows=20).where("false")
    parts = ordered.chunked(df, ["us", "id"], keys=["k"])
    assert ordered.running(parts, folds()).collect() == []
    assert ordered.previous(parts, ["v"]).collect() == []


def test_chunks_do_not_depend_on_partitioning(spark):
    df = make(spark)
    cuts = [
        ordered.chunked(d, ["us", "id"], keys=["k"], chunks=8).cuts
        for d in (df, df.repartition(7), df.orderBy(F.desc("v")))
    ]
    assert cuts[0] == cuts[1] == cuts[2]


def test_only_the_chunk_totals_meet_in_one_partition(spark):
    df = make(spark)
    parts = ordered.chunked(df, ["us", "id"], chunks=8)
    plan = ordered.running(parts, folds())._jdf.queryExecution().executedPlan().toString()
    steps = plan.splitlines()
    single = [i for i, step in enumerate(steps) if "Exchange SinglePartition" in step]
    assert len(single) == 1
    assert "HashAggregate(keys=[_chunk" in steps[single[0] + 1]


@pytest.fixture
def small_driver(monkeypatch):
    """A driver that takes few rows, and a record of how many it was sent."""
    sent = []
    real = ordered._to_driver

    def recorded(sample, limit):
        rows = real(sample, limit)
        sent.append(len(rows))
        return rows

    monkeypatch.setattr(ordered, "TOP_CUTS", 8)
    monkeypatch.setattr(ordered, "DRIVER_ROWS", 64)
    monkeypatch.setattr(ordered, "_to_driver", recorded)
    return sent


@pytest.mark.parametrize("current", [True, False])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_two_levels_equal_the_window(spark, small_driver, keys, current):
    df = make(spark)
    parts = ordered.chunked(df, ["us", "id"], keys=keys, rows_per_chunk=100)
    assert parts.fine is not None and len(parts.cuts) < 8
    assert parts.rows.select(ordered.CHUNK).distinct().count() > 30
    ours = ordered.running(parts, folds(), include_current=current)
    by = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("us", "id")
    frame = by.rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    assert same(ours.select("id", *folds()), expected(df, frame))


def test_two_levels_with_nulls_and_previous(spark, small_driver):
    df = make(spark, 3000).selectExpr("nullif(k, 'k7') AS k", "nullif(us % 50, 3) AS us", "id", "v")
    parts = ordered.chunked(df, ["us", "id"], keys=["k"], rows_per_chunk=60)
    assert parts.fine is not None
    ours = ordered.previous(parts, ["v", "us"]).select("id", "prev_v", "prev_us")
    by = Window.partitionBy("k").orderBy("us", "id")
    assert same(ours, df.select("id", F.lag("v").over(by), F.lag("us").over(by)))


def test_the_driver_is_sent_no_more_for_more_rows(spark, small_driver):
    """Ten times the rows give ten times the chunks, and the driver gets as many rows."""
    counts = []
    for rows in (20_000, 200_000):
        parts = ordered.chunked(spark.range(rows).select("id"), ["id"], rows_per_chunk=500)
        counts.append(parts.rows.select(ordered.CHUNK).distinct().count())
        assert len(parts.cuts) < 8
        last = ordered.running(parts, {"n": ordered.fold_count()}).agg(F.max("n")).head()[0]
        assert last == rows
    assert counts[1] > 8 * counts[0] > 200
    assert max(small_driver) <= 65


def test_two_levels_cut_evenly(spark, small_driver):
    df = make(spark, rows=20_000)
    parts = ordered.chunked(df, ["us", "id"], keys=["k"], rows_per_chunk=400)
    sizes = [r["count"] for r in parts.rows.groupBy(ordered.CHUNK, "k").count().collect()]
    assert max(sizes) < 4 * 400
    assert parts.rows.where("k = 'hot'").select(ordered.CHUNK).distinct().count() > 10


def test_two_levels_with_a_given_number_of_chunks(spark, small_driver):
    parts = ordered.chunked(make(spark, rows=9000), ["us", "id"], chunks=40)
    assert parts.fine is not None
    assert 20 <= parts.rows.select(ordered.CHUNK).distinct().count() <= 60


def test_running_from_a_start(spark):
    df = make(spark, 500)
    parts = ordered.chunked(df, ["us", "id"], chunks=4)
    start = {"total": F.lit(1000), "n": F.lit(None).cast("bigint"), "highest": F.lit(49), "lowest": F.lit(7)}
    ours = ordered.running(parts, folds(), start=start)
    frame = Window.partitionBy(F.lit(0)).orderBy("us", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = expected(df, frame).select(
        "id", F.col("total") + 1000, "n", F.greatest("highest", F.lit(49)), F.least("lowest", F.lit(7))
    )
    assert same(ours.select("id", *folds()), plain)


def test_given_chunks_are_a_minimum(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 7).alias("v"))
    parts = ordered.chunked(rows, ["id"], chunks=2, rows_per_chunk=25)
    assert parts.rows.groupBy(ordered.CHUNK).count().agg(F.max("count")).head()[0] <= 300
    so_far = ordered.running(parts, {"so_far": ordered.fold_sum(F.col("v"))})
    of_task = so_far.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
    assert of_task <= 1000
    assert [r.so_far for r in so_far.orderBy("id").collect()] == list(accumulate(i % 7 for i in range(4000)))
