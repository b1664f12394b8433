"""Splitting a stream into on-time and droppable rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.late import outputs, split_late
from millrace.streaming.runs import PerBatch
from millrace.streaming.state import Seen


class LateSplit:
    """A ``foreachBatch`` target with main and droppable sinks.

    Spark drops late rows before user code can see them once ``withWatermark`` is
    set, so the watermark is kept here: the latest event time of the batches before,
    minus ``delay``.  It is stored per batch id, which makes a repeated batch take
    the same decisions.
    """

    def __init__(
        self,
        state_folder: str,
        width: int,
        lateness: int,
        main: PerBatch,
        droppable: PerBatch,
        delay: int = 0,
        ts: str = "ts",
    ):
        self.seen = Seen(state_folder, ts)
        self.width, self.lateness, self.delay = width, lateness, delay
        self.main, self.droppable = main, droppable
        self.ts = ts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            self._split(batch, batch_id)
        finally:
            batch.unpersist()

    def _split(self, batch: DataFrame, batch_id: int) -> None:
        seen = self.seen.before(batch.sparkSession, batch_id)
        watermark = None if seen is None else seen - self.delay
        met = batch.withColumn("_met", F.lit(watermark).cast("bigint"))
        tagged = split_late(
            met, [], self.width, self.lateness, ts=self.ts, watermark="_met"
        ).drop("_met")
        on_time, late = outputs(tagged)
        self.main(on_time, batch_id)
        self.droppable(late, batch_id)
        self.seen.record(batch, batch_id)
