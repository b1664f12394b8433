"""Rows given in the program itself."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def from_values(spark: SparkSession, values: Iterable, schema: str) -> DataFrame:
    """In-memory rows: tuples, or single values for a one-column schema.

    A mapping yields its keys only; a ``range`` is generated by the executors.
    """
    if isinstance(values, range):
        return spark.range(values.start, values.stop, values.step).toDF(schema.split()[0])
    if isinstance(values, Mapping):
        values = values.keys()
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    return spark.createDataFrame(rows, schema)
