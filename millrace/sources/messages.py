"""Message logs: (key, value, timestamp) rows in, key and JSON value out.

The log's connector is an external package (``spark-sql-kafka``).  Everything past
the reader works on the three columns, so a folder of files with the same columns
can stand in for a topic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.parsing import EVENT_LOG_FIELDS
from millrace.plans.shared import exists
from millrace.plans.sizing import broadcast_if_small

MESSAGE = "key BINARY, value BINARY, timestamp TIMESTAMP"


def read_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: Sequence[str],
    group_id: str | None = None,
    starting_offsets: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """A stream of messages; the timestamp is the message's create time."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    if group_id:
        reader = reader.option("groupIdPrefix", group_id)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select("key", "value", "timestamp")


def read_message_files(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from a folder of parquet files."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def decoded(messages: DataFrame) -> DataFrame:
    """Text of each message with its event time."""
    return messages.select(
        F.decode("value", "UTF-8").alias("value"), F.col("timestamp").alias("ts")
    )


def _json(fields: Sequence[str] | dict[str, str]) -> Column:
    named = fields if isinstance(fields, dict) else {f: f for f in fields}
    columns = [F.col(source).alias(name) for name, source in named.items()]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def to_messages(
    rows: DataFrame,
    value: Sequence[str] | dict[str, str],
    key: Sequence[str] | dict[str, str] | None = None,
) -> DataFrame:
    """Key and value of the outgoing message; ``{json name: column}`` renames.

    Without key fields the key is empty.
    """
    key_text = _json(key) if key else F.lit("")
    return rows.select(
        key_text.cast("binary").alias("key"), _json(value).cast("binary").alias("value")
    )


def passthrough(log: DataFrame) -> DataFrame:
    """Parsed web-log rows back to messages, keyed by user and event time."""
    return to_messages(log, EVENT_LOG_FIELDS, {"event_id": "id", "event_ts": "event_ts"})


def write_topic(
    messages: DataFrame,
    bootstrap_servers: str,
    topic: str,
    checkpoint: str,
    output_mode: str = "append",
    interval: str | None = "60 seconds",
) -> StreamingQuery:
    """Send a stream of messages; each is delivered at least once."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    if interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


class MessageLog:
    """A folder in place of a topic, and a ``foreachBatch`` target that sends to it.

    Messages are appended, never replaced, as in a topic: a batch that Spark runs again is
    sent again.  Each attempt marks its messages with the batch's id and a name of its own,
    and says at the end that it is complete.  Readers take the first complete attempt of
    each batch, so every message is seen once, whatever attempts were broken off or repeated.
    """

    ATTEMPT = "batch_id BIGINT, attempt STRING"

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        attempt = self.append(batch, batch_id)
        self.complete(batch.sparkSession, batch_id, attempt)

    def append(self, batch: DataFrame, batch_id: int) -> str:
        """Send a batch's messages; the attempt counts once it is completed."""
        attempt = uuid.uuid4().hex
        marks = {"batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)}
        sent = batch.select("key", "value").withColumns(marks)
        sent.write.mode("append").parquet(f"{self.folder}/messages")
        return attempt

    def complete(self, spark: SparkSession, batch_id: int, attempt: str) -> None:
        end = spark.createDataFrame([(batch_id, attempt)], self.ATTEMPT)
        end = end.withColumn("ended", F.current_timestamp()).coalesce(1)
        end.write.mode("append").parquet(f"{self.folder}/ends")

    def received(self, spark: SparkSession) -> DataFrame:
        """Each message once, with the id of its batch."""
        if not exists(spark, f"{self.folder}/ends"):
            return spark.createDataFrame([], "key BINARY, value BINARY, batch_id BIGINT")
        sent = f"key BINARY, value BINARY, {self.ATTEMPT}"
        messages = spark.read.schema(sent).parquet(f"{self.folder}/messages")
        ends = spark.read.schema(f"{self.ATTEMPT}, ended TIMESTAMP").parquet(f"{self.folder}/ends")
        first = F.min_by("attempt", F.struct("ended", "attempt")).alias("attempt")
        counted = ends.groupBy("batch_id").agg(first)
        return messages.join(broadcast_if_small(counted), ["batch_id", "attempt"]).select(
            "key", "value", "batch_id"
        )
