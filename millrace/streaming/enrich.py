"""Enrichment on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.text import first_letter_bucket
from millrace.operators.enrich import Client, answer_in_batches, length_service
from millrace.plans import panes
from millrace.plans.ordered import chunked, fold_count, running
from millrace.plans.shared import remove
from millrace.plans.sizing import broadcast_if_small
from millrace.streaming.runs import PerBatch
from millrace.streaming.state import Note


def enrich_batch_sized(
    words: DataFrame,
    batch_size: int = 10,
    max_wait_secs: int = 4,
    salts: int | None = None,
    word: str = "word",
    open_client: Callable[[], Client] = length_service,
) -> DataFrame:
    """Answers in calls of ``batch_size`` rows per bucket, or after ``max_wait_secs``.

    ``words`` has the word and its ``ts``.  Rows that do not fill a call wait in the
    bucket's state.  Salting the ten first-letter buckets lets every shuffle partition
    work; a call still never mixes buckets.  A client is closed after the group it was
    opened for.
    """
    salts = salts or int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def call(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        client = open_client()
        try:
            yield from answered(client, frames, state)
        finally:
            if close := getattr(client, "close", None):
                close()

    def answered(
        client: Client, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [])
        waiting = pd.DataFrame({word: list(held[0]), "ts": pd.to_datetime(list(held[1]))})
        if state.hasTimedOut:
            state.remove()
            if len(waiting):
                yield answer_in_batches(client, waiting, batch_size, word, "length")
            return
        for frame in frames:
            rows = frame[[word, "ts"]]
            waiting = pd.concat([waiting, rows], ignore_index=True) if len(waiting) else rows
            full = len(waiting) - len(waiting) % batch_size
            if full:
                ready = waiting.iloc[:full]
                yield answer_in_batches(client, ready, batch_size, word, "length")
            waiting = waiting.iloc[full:]
        if len(waiting):
            stamps = [stamp.to_pydatetime() for stamp in waiting["ts"]]
            state.update((waiting[word].tolist(), stamps))
            state.setTimeoutDuration(max_wait_secs * 1000)
        elif state.exists:
            state.remove()

    salt = F.pmod(F.xxhash64(word, "ts"), F.lit(salts))
    keyed = words.select(
        first_letter_bucket(F.col(word)).alias("bucket"), salt.alias("salt"), word, "ts"
    )
    return keyed.groupBy("bucket", "salt").applyInPandasWithState(
        call,
        f"{word} STRING, ts TIMESTAMP, length INT",
        "words ARRAY<STRING>, stamps ARRAY<TIMESTAMP>",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


class RefreshedLookup:
    """A ``foreachBatch`` target joining orders with a lookup that is reloaded in time.

    The lookup is read again, with the next version number, when a batch falls into a
    later time bucket than the one the lookup was loaded for.  It is then written to the
    shared folder, so that all batches of a bucket see the same rows.  Each batch's version
    and bucket are written before it is joined: a repeated batch joins what it joined at
    first, and a restarted stream goes on with the version it had.  The last two batches'
    decisions and versions are kept.
    """

    def __init__(
        self,
        state_folder: str,
        load: Callable[[Any, int], DataFrame],
        max_stale_sec: int,
        sink: PerBatch,
        clock: Callable[[], float],
    ):
        self.state_folder, self.note = state_folder, Note(f"{state_folder}/batch")
        self.load, self.max_stale_sec, self.sink, self.clock = load, max_stale_sec, sink, clock

    def _decide(self, spark: SparkSession, batch_id: int) -> int:
        """The batch's version; its bucket is noted with it."""
        decided = self.note.of(spark, batch_id)
        if decided:
            return decided[0]
        version, tag = self.note.of(spark, batch_id - 1) or (0, None)
        now = self.clock()
        bucket = now - now % self.max_stale_sec
        if tag is None or bucket > tag:
            version, tag = version + 1, bucket
            loaded = self.load(spark, version).withColumn("version", F.lit(version))
            loaded.write.mode("overwrite").parquet(f"{self.state_folder}/lookup/{version}")
            remove(spark, f"{self.state_folder}/lookup/{version - 2}")
        self.note.record(spark, batch_id, (version, tag))
        return version

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = self._decide(spark, batch_id)
        lookup = spark.read.parquet(f"{self.state_folder}/lookup/{version}")
        self.sink(batch.join(broadcast_if_small(lookup), "customer_id", "left"), batch_id)


def periodic(orders: DataFrame, ts: str = "ts") -> DataFrame:
    """Orders of a stream as (order_id, customer_id, timestamp in seconds)."""
    seconds = F.floor(panes.micros(F.col(ts)) / panes.SECOND).cast("bigint")
    return orders.select(
        F.col("order_id").cast("string").alias("order_id"),
        "customer_id",
        seconds.alias("timestamp"),
    )


class PeriodicFirings:
    """A ``foreachBatch`` target that gives out orders five at a time, an interval apart.

    Orders are numbered over all batches in their order, in chunks; the number so far is
    kept per batch id.  An order's firing is its number divided by ``every``, and its time
    is the start plus so many intervals.
    """

    def __init__(
        self,
        state_folder: str,
        sink: PerBatch,
        order: Sequence[str],
        start: int = 0,
        interval_sec: int = 5,
        every: int = 5,
        chunks: int | None = None,
    ):
        self.note, self.sink, self.order = Note(state_folder), sink, list(order)
        self.start, self.interval_sec, self.every = start, interval_sec, every
        self.chunks = chunks

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.note.of(spark, batch_id - 1) or 0
        batch = batch.persist()
        try:
            parts = chunked(batch, self.order, chunks=self.chunks)
            begun = {"_n": F.lit(before).cast("bigint")}
            numbered = running(parts, {"_n": fold_count()}, start=begun)
            firing = F.floor((F.col("_n") - 1) / self.every).cast("bigint")
            fired = numbered.withColumns(
                {"firing": firing, "timestamp": self.start + firing * self.interval_sec}
            )
            self.sink(fired.select("order_id", "customer_id", "firing", "timestamp"), batch_id)
            self.note.record(spark, batch_id, before + batch.count())
        finally:
            batch.unpersist()
