"""Sales streams: count panes, and windows that fire again and again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import panes
from millrace.plans.ordered import chunked, fold_count, running
from millrace.plans.sizing import broadcast_if_small
from millrace.streaming.runs import PerBatch
from millrace.streaming.state import ChangeLog, Seen

LONG = T.LongType()


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, LONG) for name in names]


class CountPanes:
    """A ``foreachBatch`` target that fires a key's pane when it has ``every`` rows.

    Rows are numbered per key in their order within the batch, as the bounded operator
    numbers a table: in chunks, so that a key with most of a batch is spread over many
    tasks.  A batch may fill several panes of a key.  What does not fill one is carried as
    sums, in a log of the keys that the batch changed.
    """

    def __init__(
        self,
        state_folder: str,
        sink: PerBatch,
        order: Sequence[str],
        every: int = 5,
        key: str = "city",
        value: str = "profit",
        chunks: int | None = None,
        compact_every: int = 10,
    ):
        self.state_folder, self.sink, self.order = state_folder, sink, list(order)
        self.every, self.key, self.value, self.chunks = every, key, value, chunks
        self.compact_every = compact_every

    def log(self, rows: DataFrame) -> ChangeLog:
        """Per key: rows so far, and how many and what sum its unfinished pane has."""
        schema = T.StructType([rows.schema[self.key], *_longs("seen", "sales", self.value)])
        return ChangeLog(self.state_folder, schema, [self.key], self.compact_every)

    def _pane(self, number: Column) -> Column:
        return F.floor((number - 1) / self.every).cast("bigint")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        log = self.log(batch)
        # Null keys are a key; a join by equality would lose them.
        same = [F.col("_k").eqNullSafe(F.col(self.key))]
        touched = batch.select(F.col(self.key).alias("_k")).distinct()
        carried = log.before(batch.sparkSession, batch_id).join(touched, same, "left_semi")
        carried = carried.persist()
        before = carried.select(F.col(self.key).alias("_k"), F.col("seen").alias("_seen"))
        parts = chunked(batch, self.order, keys=[self.key], chunks=self.chunks)
        numbered = running(parts, {"_n": fold_count()})
        numbered = numbered.join(broadcast_if_small(before), same, "left")
        seen = F.col("_n") + F.coalesce("_seen", F.lit(0))
        sums = numbered.groupBy(self.key, self._pane(seen).alias("pane")).agg(
            F.count("*").alias("sales"), F.sum(self.value).alias(self.value)
        )
        open_before = carried.select(
            self.key, self._pane(F.col("seen") + 1).alias("pane"), "sales", self.value
        )
        fired = (
            sums.unionByName(open_before)
            .groupBy(self.key, "pane")
            .agg(F.sum("sales").alias("sales"), F.sum(self.value).alias(self.value))
            .persist()
        )
        try:
            self.sink(fired.where(F.col("sales") == self.every), batch_id)
            unfinished = F.col("sales") < self.every
            state = fired.groupBy(self.key).agg(
                F.max(F.col("pane") * self.every + F.col("sales")).alias("seen"),
                *[
                    F.coalesce(F.sum(F.when(unfinished, F.col(c))), F.lit(0)).alias(c)
                    for c in ("sales", self.value)
                ],
            )
            log.record(batch_id, state)
        finally:
            for table in (fired, carried, batch):
                table.unpersist()

    def closing(self, spark: SparkSession, like: DataFrame) -> DataFrame:
        """The panes that the end of the input leaves unfinished, after the last batch."""
        log = self.log(like)
        left = log.after(spark, log.newest(spark)).where("sales > 0")
        return left.select(self.key, self._pane(F.col("seen")).alias("pane"), "sales", self.value)


EARLY, ON_TIME, LATE = "early", "on time", "late"


class AccumulatingPanes:
    """A ``foreachBatch`` target that shows a window's sum so far whenever it changed.

    Each micro-batch is a firing.  A pane has its number within the window and key, the sum
    of all rows so far, and its timing: early before the watermark has passed the window's
    end, on time the first time after, and late from then on.  Rows of a window whose end
    plus ``lateness`` the watermark has passed are dropped, as is the window's state.  The
    watermark is the latest time of the batches before, minus ``delay``.
    """

    def __init__(
        self,
        state_folder: str,
        sink: PerBatch,
        width: int,
        lateness: int,
        delay: int = 0,
        key: str = "city",
        value: str = "profit",
        ts: str = "ts",
        compact_every: int = 10,
    ):
        self.state_folder, self.sink = state_folder, sink
        self.width, self.lateness, self.delay = width, lateness, delay
        self.key, self.value, self.ts = key, value, ts
        self.compact_every = compact_every
        self.seen = Seen(f"{state_folder}/seen", ts)

    def shape(self, rows: DataFrame) -> DataFrame:
        """An empty table with the columns that are shown."""
        bounds = "window_start TIMESTAMP, window_end TIMESTAMP, pane BIGINT, timing STRING"
        fields = T.StructType.fromDDL(f"{bounds}, {self.value} BIGINT").fields
        schema = T.StructType([rows.schema[self.key], *fields])
        return rows.sparkSession.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self._fire(batch, batch_id)
            self.seen.record(batch, batch_id)
        finally:
            batch.unpersist()

    def _fire(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = [self.key, "_start"]
        state = [batch.schema[self.key], *_longs("_start", self.value, "pane", "_closed")]
        log = ChangeLog(
            f"{self.state_folder}/panes", T.StructType(state), keys, self.compact_every
        )
        seen = self.seen.before(spark, batch_id)
        watermark = F.lit(None if seen is None else seen - self.delay).cast("bigint")
        end = F.col("_start") + self.width
        closed = F.coalesce(watermark >= end, F.lit(False))
        expired = F.coalesce(watermark >= end + self.lateness, F.lit(False))
        start = panes.floor_to(panes.micros(F.col(self.ts)), self.width)
        sums = (
            batch.where(F.col(self.ts).isNotNull())
            .groupBy(self.key, start.alias("_start"))
            .agg(F.sum(self.value).cast("bigint").alias("_added"))
            .where(~expired)
        )
        kept = log.before(spark, batch_id).persist()
        earlier = kept.select(
            F.col(self.key).alias("_k"),
            F.col("_start").alias("_s"),
            F.col(self.value).alias("_before"),
            F.col("pane").alias("_pane"),
            F.col("_closed").alias("_was_closed"),
        )
        same = F.col("_k").eqNullSafe(F.col(self.key)) & (F.col("_s") == F.col("_start"))
        timing = F.when(~closed, EARLY).when(F.coalesce("_was_closed", F.lit(0)) == 0, ON_TIME)
        fired = (
            sums.join(earlier, same, "left")
            .select(
                *keys,
                (F.coalesce("_before", F.lit(0)) + F.col("_added")).alias(self.value),
                (F.coalesce("_pane", F.lit(-1)) + 1).cast("bigint").alias("pane"),
                closed.cast("bigint").alias("_closed"),
                timing.otherwise(LATE).alias("timing"),
            )
            .persist()
        )
        try:
            shown = fired.select(
                self.key,
                panes.from_micros(F.col("_start")).alias("window_start"),
                panes.from_micros(end).alias("window_end"),
                "pane",
                "timing",
                self.value,
            )
            self.sink(shown, batch_id)
            log.record(batch_id, fired, kept.where(expired))
        finally:
            fired.unpersist()
            kept.unpersist()
