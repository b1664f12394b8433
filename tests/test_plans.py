"""Size checks, the shared folder, and what the plans push down."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import orders, traffic, words
from millrace.plans import shared, sizing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_limit(spark):
    table = spark.range(1000)
    other = spark.range(100_000_000).withColumnRenamed("id", "id")
    assert "BroadcastHashJoin" in plan_of(other.join(sizing.broadcast_if_small(table), "id"))
    hinted = sizing.broadcast_if_small(table, limit=10)
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()


def test_large_lookup_is_not_broadcast(spark):
    big = spark.range(50_000_000).select(F.col("id").alias("customer_id"), F.lit("x").alias("n"))
    facts = spark.range(60_000_000).select(F.col("id").alias("customer_id"))
    plan = plan_of(orders.enrich_orders_static(facts, big))
    assert "BroadcastHashJoin" not in plan and "LeftOuter" in plan


def test_spread_only_small_unsplit_inputs(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    assert sizing.spread(one).rdd.getNumPartitions() == 4
    enough = spark.range(0, 100, 1, 8)
    assert sizing.spread(enough) is enough


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (shared.shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(root) and second.startswith(root) and first != second


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session(), "x")


def test_only_needed_columns_are_read(spark, tmp_path):
    spark.sql(
        "SELECT '7' AS id, 5 AS file_size_bytes, 'wide' AS user_agent, timestamp_seconds(1) AS ts"
    ).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    plan = plan_of(traffic.user_traffic(log))
    assert "ReadSchema: struct<id:string,file_size_bytes:int>" in plan
    assert "partial_count" in plan


def test_top_k_limits_each_partition_before_the_shuffle(lines):
    plan = words.top_k_words(lines(("a b", 0)))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
