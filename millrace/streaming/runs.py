"""Running a stream into a folder and reading what it emitted."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.shared import shared_folder

BATCH = "batch_id"
PerBatch = Callable[[DataFrame, int], None]


def into_batches(folder: str) -> PerBatch:
    """A sink that keeps each micro-batch in a folder of its own.

    A batch that is run again after a failure replaces its own output only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")

    return write


def start(
    stream: DataFrame,
    sink: PerBatch,
    checkpoint: str,
    mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Start a stream; without an interval it stops after what is there now."""
    writer = (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def drain(stream: DataFrame, sink: PerBatch, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is available, then stop."""
    start(stream, sink, checkpoint, mode).awaitTermination()


def settle(
    stream: DataFrame,
    sink: PerBatch,
    checkpoint: str,
    mode: str = "append",
    interval: str = "1 second",
    patience: float = 600,
) -> None:
    """Run on a timer until all input is read and no state waits for its time."""
    query = start(stream, sink, checkpoint, mode, interval)
    deadline = time.monotonic() + patience
    try:
        while not _settled(query):
            if query.exception():
                raise query.exception()
            if time.monotonic() > deadline:
                raise TimeoutError(f"state is still waiting after {patience} seconds")
            time.sleep(0.2)
    finally:
        query.stop()


def _settled(query: StreamingQuery) -> bool:
    """Whether the last trigger found no input, after one that did, and left no state."""
    progress = query.recentProgress
    if not any(p.numInputRows for p in progress):
        return False
    last = progress[-1]
    return not last.numInputRows and not any(s.numRowsTotal for s in last.stateOperators)


def emitted(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Everything a stream emits for what is available now, with its batch id."""
    spark: SparkSession = stream.sparkSession
    folder = shared_folder(spark, "stream")
    drain(stream, into_batches(f"{folder}/out"), f"{folder}/checkpoint", mode)
    return read_batches(spark, f"{folder}/out", stream)


def read_batches(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    schema = T.StructType([*like.schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/{BATCH}=*")


def latest(panes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last pane emitted for each key."""
    rest = [c for c in panes.columns if c not in (*keys, BATCH)]
    last = F.max_by(F.struct(*rest), F.col(BATCH)).alias("_last")
    return panes.groupBy(*keys).agg(last).select(*keys, *[f"_last.{c}" for c in rest])
