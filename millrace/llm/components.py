"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node.

    Large-star and small-star rounds: every node's neighbours are hung below the least
    of them, those above it and then those below, until nothing changes.  Neighbourhoods
    are only ever reduced to their least node, and the edges never become more.
    """
    least = edges.select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).filter("high > low")
    stars = written(least.distinct(), "edges")
    mark = _mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("high").alias("low"), F.col("low").alias("high")))
        # In ``both`` each node stands as ``high`` with all its neighbours as ``low``.
        heads = both.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("head"))
        large = (
            both.join(heads, "high")
            .filter("low > high")
            .select(F.col("low").alias("high"), F.col("head").alias("low"))
            .distinct()
        )
        large = written(large, "large-star")
        heads = large.groupBy("high").agg(F.min("low").alias("head"))
        small = (
            large.join(heads, "high")
            .filter("low > head")
            .select(F.col("low").alias("high"), F.col("head").alias("low"))
            .unionByName(heads.withColumnRenamed("head", "low"))
            .distinct()
        )
        stars = written(small, "small-star")
        last, mark = mark, _mark(stars)
        if mark == last:
            break
    return stars.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        stars.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    digest = F.xxhash64("high", "low")
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(digest.cast("decimal(38,0)")), F.bit_xor(digest)).first()
    )
