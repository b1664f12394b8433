"""State of ``foreachBatch`` targets, kept in files of the shared folder.

A target is told its batch id, and Spark runs the last batch again after a failure.  So
what a batch leaves behind is written under its id, replacing what an earlier attempt left,
and a batch reads only what the batches before it wrote: a repeated batch starts from the
same state.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import panes
from millrace.plans.shared import file_names, get_text, put_text, remove

GONE, AT = "_gone", "_at"


class ChangeLog:
    """Rows by key; each batch writes those that it changed, and no others.

    Every ``every`` batches the live rows are written as a whole.  The state before a batch is
    the last whole one and the changes since, the latest of each key.  What is older than
    is needed to start again from any of the last ``every`` batches is removed.
    """

    def __init__(self, folder: str, schema: T.StructType, keys: Sequence[str], every: int = 10):
        self.folder, self.schema, self.keys, self.every = folder, schema, list(keys), every
        self.values = [f.name for f in schema if f.name not in self.keys]
        marks = [T.StructField(GONE, T.BooleanType()), T.StructField(AT, T.LongType())]
        self.stored = T.StructType([*schema.fields, *marks])

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}/{batch_id}"

    def _read(self, spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).parquet(*paths)

    def _live(self, log: DataFrame) -> DataFrame:
        """The latest row of each key, unless that says the key is gone."""
        latest = F.max_by(F.struct(*self.values, GONE), F.col(AT)).alias("_last")
        rows = log.groupBy(*self.keys).agg(latest).where(~F.col(f"_last.{GONE}"))
        values = [F.col(f"_last.{v}").alias(v) for v in self.values]
        return rows.select(*self.keys, *values).select(*self.schema.fieldNames())

    def _log(self, spark: SparkSession, batch_id: int, whole: int) -> DataFrame:
        """The whole state after batch ``whole``, if not 0, and the changes up to ``batch_id``."""
        paths = [self._path("whole", whole)] if whole else []
        first = whole + 1 if whole else 0
        return self._read(
            spark, paths + [self._path("changes", i) for i in range(first, batch_id + 1)]
        )

    def after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The live rows after a batch that has been recorded."""
        whole = max(batch_id, 0) // self.every * self.every
        return self._live(self._log(spark, batch_id, whole))

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.after(spark, batch_id - 1)

    def newest(self, spark: SparkSession) -> int:
        """The last recorded batch; -1 before the first."""
        return max(map(int, file_names(spark, f"{self.folder}/changes")), default=-1)

    def record(self, batch_id: int, changed: DataFrame, gone: DataFrame | None = None) -> None:
        """Write a batch's new and changed rows, and the keys of rows that are no more."""
        spark = changed.sparkSession
        rows = changed.select(*self.schema.fieldNames(), F.lit(False).alias(GONE))
        if gone is not None:
            empty = [F.lit(None).cast(self.schema[v].dataType).alias(v) for v in self.values]
            left = gone.select(*self.keys, *empty, F.lit(True).alias(GONE))
            rows = rows.unionByName(left)
        rows = rows.withColumn(AT, F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(self._path("changes", batch_id))
        if batch_id and batch_id % self.every == 0:
            self._compact(spark, batch_id)

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        before = batch_id - self.every
        live = self._live(self._log(spark, batch_id, before))
        marks = {GONE: F.lit(False), AT: F.lit(batch_id).cast("bigint")}
        live.withColumns(marks).write.mode("overwrite").parquet(self._path("whole", batch_id))
        if before:
            older = before - self.every
            remove(spark, self._path("whole", older))
            for old in range(older + 1 if older else 0, before + 1):
                remove(spark, self._path("changes", old))


class Note:
    """A small value per batch id, in a file of its own; the last two are kept."""

    def __init__(self, folder: str):
        self.folder = folder

    def of(self, spark: SparkSession, batch_id: int) -> Any:
        """What was noted for a batch; null if nothing was."""
        text = get_text(spark, f"{self.folder}/{batch_id}")
        return None if text is None else json.loads(text)

    def record(self, spark: SparkSession, batch_id: int, value: Any) -> None:
        put_text(spark, f"{self.folder}/{batch_id}", json.dumps(value))
        remove(spark, f"{self.folder}/{batch_id - 2}")


class Seen:
    """The latest event time of all batches so far, by batch id."""

    def __init__(self, folder: str, ts: str = "ts"):
        self.note, self.ts = Note(folder), ts

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        """In microseconds; null until a batch with a time is through."""
        return self.note.of(spark, batch_id - 1)

    def record(self, batch: DataFrame, batch_id: int) -> int | None:
        """Take in a batch's times, and return the latest so far."""
        spark = batch.sparkSession
        earlier = self.before(spark, batch_id)
        highest = batch.agg(F.max(panes.micros(F.col(self.ts)))).head()[0]
        seen = max((t for t in (earlier, highest) if t is not None), default=None)
        self.note.record(spark, batch_id, seen)
        return seen
