"""Orders enriched from a customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import panes
from millrace.plans.ordered import chunked, fold_count, running
from millrace.plans.sizing import broadcast_if_small


def enrich_orders_static(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer attributes per order; orders of unknown customers stay without.

    The lookup is broadcast below a checked size.  Beyond it the join shuffles, and
    AQE splits the partitions of customers with very many orders.
    """
    return orders.join(broadcast_if_small(customers), "customer_id", "left")


def lookup_versions(
    orders: DataFrame, max_stale: int, ts: str = "ts", chunks: int | None = None
) -> DataFrame:
    """Time buckets in which orders arrived, numbered from 1.

    The lookup is reloaded when an order arrives in a later bucket than the one it
    was loaded for, so the number is the version that this bucket's orders see.
    """
    bucket = panes.floor_to(panes.micros(F.col(ts)), max_stale)
    seen = orders.select(bucket.alias("bucket")).distinct()
    return running(chunked(seen, ["bucket"], chunks=chunks), {"version": fold_count()}).select(
        "bucket", "version"
    )


def enrich_orders_refreshed(
    orders: DataFrame,
    customers: DataFrame,
    max_stale: int,
    ts: str = "ts",
    chunks: int | None = None,
) -> DataFrame:
    """Orders with the attributes and the version of the lookup they would have met."""
    versions = lookup_versions(orders, max_stale, ts, chunks)
    bucket = panes.floor_to(panes.micros(F.col(ts)), max_stale)
    known = customers.withColumn("_known", F.lit(True))
    joined = (
        orders.withColumn("bucket", bucket)
        .join(versions, "bucket", "left")
        .join(broadcast_if_small(known), "customer_id", "left")
    )
    return joined.withColumn(
        "version", F.when(F.col("_known"), F.col("version"))
    ).drop("bucket", "_known")
