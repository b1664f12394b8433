"""Accumulators against built-in aggregates."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType
from rows import tuples

from millrace.operators.accumulate import Longest, Mean, accumulated


def table(spark, rows=3000):
    rng = random.Random(11)
    data = [
        (rng.choice(["hot"] * 5 + [None, "a", "b", f"k{rng.randrange(200)}"]), rng.choice([None, *range(50)]))
        for _ in range(rows)
    ]
    return spark.createDataFrame(data, "k STRING, v BIGINT").repartition(7)


@pytest.mark.parametrize(("salts", "held"), [(1, 10_000), (16, 3), (5, 0)])
def test_mean_per_key(spark, salts, held):
    df = table(spark)
    found = accumulated(df, ["k"], "v", Mean(), DoubleType(), salts=salts, held=held)
    expected = df.groupBy("k").agg(F.coalesce(F.avg("v"), F.lit(float("nan"))).alias("result"))
    key, value = F.coalesce("k", F.lit("-")), F.col("result").cast("string")
    assert tuples(found, key, value) == tuples(expected, key, value)


def test_mean_of_all_and_of_nothing(spark):
    df = table(spark)
    assert accumulated(df, [], "v", Mean(), DoubleType()).head()[0] == df.agg(F.avg("v")).head()[0]
    empty = accumulated(df.limit(0), [], "v", Mean(), DoubleType()).collect()
    assert len(empty) == 1 and math.isnan(empty[0].result)
    assert accumulated(df.limit(0), [], "v", Mean(), DoubleType(), defaults=False).collect() == []
    assert accumulated(df.limit(0), ["k"], "v", Mean(), DoubleType()).collect() == []


def test_longest_different_texts(spark):
    rng = random.Random(12)
    rows = [(rng.randrange(4), "x" * rng.randrange(6) + rng.choice("abc")) for _ in range(900)]
    df = spark.createDataFrame([*rows, (1, None), (9, None)], "k INT, w STRING").repartition(6)
    found = accumulated(df, ["k"], "w", Longest(4), ArrayType(StringType()), "best", held=2)
    expected = {
        k: sorted({w for i, w in rows if i == k}, key=lambda w: (-len(w), w))[:4] for k in (0, 1, 2, 3)
    }
    assert {r.k: r.best for r in found.collect()} == expected | {9: []}


def test_own_accumulator_by_two_keys(spark):
    class Distinct:
        """How many different values: its states are sets."""

        def create(self):
            return set()

        def add(self, state, value):
            return state | {value}

        def merge(self, left, right):
            return left | right

        def extract(self, state):
            return len(state)

    df = table(spark).withColumn("odd", F.col("v") % 2 == 1).where("v IS NOT NULL")
    found = accumulated(df, ["k", "odd"], "v", Distinct(), LongType(), "n")
    expected = df.groupBy("k", "odd").agg(F.countDistinct("v").alias("n"))
    key = F.coalesce("k", F.lit("-"))
    assert tuples(found, key, "odd", "n") == tuples(expected, key, "odd", "n")


def test_a_hot_key_is_merged_in_several_tasks(spark):
    """Its partial states differ in their salts, so no task of the second step has them all."""
    df = spark.range(4000).selectExpr("'hot' AS k", "id AS v").repartition(8)
    plan = accumulated(df, ["k"], "v", Mean(), DoubleType())._jdf.queryExecution().toString()
    assert "hashpartitioning(k" in plan and "_salt" in plan
    assert accumulated(df, ["k"], "v", Mean(), DoubleType(), held=0).head().result == 3999 / 2
