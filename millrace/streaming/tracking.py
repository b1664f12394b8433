"""Position streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import pace
from millrace.operators.tracking import boxed_metrics, position_pairs
from millrace.plans import panes
from millrace.streaming.runs import PerBatch
from millrace.streaming.state import ChangeLog, Seen


class BoxedMetrics:
    """A ``foreachBatch`` target that turns positions into distances and durations.

    Positions wait in a buffer until the watermark, the latest time so far minus ``delay``,
    has reached them, so up to that delay they may come in any order.  What it releases is
    ordered together with the last position released per user, as the bounded operator
    orders a table: a user with most of the batch is spread over many tasks instead of
    being one key of a state operator.  Both are logs of changes, so a batch writes as much
    as it changed, and a repeated batch starts from the same state.

    Positions that come after the watermark has passed them, or without a time, go to
    ``late``, if there is one.  A last row far in the future releases all others.

    ``keep_pauses`` keeps the pairs between which no time passed, whose distance counts
    for a speed but not for a pace, and gives a user's first position a pair of zeros,
    so that a user with a single position has a speed as well.
    """

    def __init__(
        self,
        state_folder: str,
        sink: PerBatch,
        tie: str,
        keep_pauses: bool = False,
        delay: int = 0,
        late: PerBatch | None = None,
        compact_every: int = 10,
    ):
        self.state_folder, self.sink, self.tie, self.late = state_folder, sink, tie, late
        self.keep_pauses, self.delay, self.compact_every = keep_pauses, delay, compact_every
        self.seen = Seen(f"{state_folder}/seen")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select("user", "spot", "ts", self.tie).persist()
        try:
            self._take(fresh, batch_id)
        finally:
            fresh.unpersist()

    def _logs(self, schema: T.StructType) -> tuple[ChangeLog, ChangeLog]:
        """Positions that wait, and the last released one of each user."""
        every = self.compact_every
        keys = ["user", "ts", self.tie]
        return (
            ChangeLog(f"{self.state_folder}/waiting", schema, keys, every),
            ChangeLog(f"{self.state_folder}/last", schema, ["user"], every),
        )

    def _take(self, fresh: DataFrame, batch_id: int) -> None:
        spark = fresh.sparkSession
        waiting, last = self._logs(fresh.schema)
        at = panes.micros(F.col("ts"))
        passed = self.seen.before(spark, batch_id)
        in_time = at > passed - self.delay if passed is not None else F.col("ts").isNotNull()
        in_time = F.coalesce(in_time, F.lit(False))
        if self.late is not None:
            self.late(fresh.where(~in_time), batch_id)
        seen = self.seen.record(fresh, batch_id)
        on_time = fresh.where(in_time)
        if not self.delay:
            # The watermark is the batch's latest time, so nothing of it has to wait.
            self._flush(on_time, last, batch_id)
            return
        released = at <= seen - self.delay if seen is not None else F.lit(False)
        held = waiting.before(spark, batch_id).persist()
        ready = on_time.unionByName(held).where(released).persist()
        try:
            self._flush(ready, last, batch_id)
            waiting.record(batch_id, on_time.where(~released), held.where(released))
        finally:
            ready.unpersist()
            held.unpersist()

    def _flush(self, ready: DataFrame, log: ChangeLog, batch_id: int) -> None:
        users = ready.select("user").distinct()
        kept = log.before(ready.sparkSession, batch_id).join(users, "user", "left_semi").persist()
        positions = ready.unionByName(kept).persist()
        try:
            self.sink(self._pairs(positions, ready, kept), batch_id)
            order = F.struct("ts", self.tie)
            latest = F.max_by(F.struct("spot", "ts", self.tie), order).alias("last")
            moved = ready.groupBy("user").agg(latest)
            log.record(batch_id, moved.select("user", "last.*"))
        finally:
            positions.unpersist()
            kept.unpersist()

    def _pairs(self, positions: DataFrame, ready: DataFrame, kept: DataFrame) -> DataFrame:
        if not self.keep_pauses:
            return boxed_metrics(positions, self.tie)
        zero = F.lit(0).cast("bigint")
        first = ready.join(kept.select("user"), "user", "left_anti").groupBy("user")
        first = first.agg(F.min("ts").alias("ts"))
        return position_pairs(positions, self.tie).unionByName(
            first.select("user", "ts", zero.alias("distance"), zero.alias("duration"))
        )


def running_track_speed(metrics: DataFrame) -> DataFrame:
    """Speed so far per user from a stream of pairs with pauses; for update mode."""
    sums = metrics.groupBy("user").agg(
        F.sum("distance").alias("distance"), F.sum("duration").alias("duration")
    )
    return sums.select(
        "user", pace.speed(F.col("distance"), F.col("duration")).alias("speed")
    )


def motivation(metrics: DataFrame, short: int, long: int, delay: str) -> DataFrame:
    """Status per user and short window, as one streaming aggregate.

    A long window is paired with the short window that holds its last tick.  Both lie in
    the window that starts with the long one and ends with the short one, which is the
    long one itself where short windows tile it.  So both paces come from the same
    sliding window, without a join or a second state.  ``window_end`` is the short
    window's.
    """
    both = -(-long // short) * short
    window = F.window("ts", panes.duration(both), panes.duration(short))
    placed = metrics.withWatermark("ts", delay).withColumn("window", window)
    at = panes.micros(F.col("ts"))
    recent = at >= panes.micros(F.col("window.end")) - short
    inside = at < panes.micros(F.col("window.start")) + long
    sums = placed.groupBy("user", "window").agg(
        F.sum(F.when(recent, F.col("distance"))).alias("short_distance"),
        F.sum(F.when(recent, F.col("duration"))).alias("short_duration"),
        F.sum(F.when(inside, F.col("distance"))).alias("distance"),
        F.sum(F.when(inside, F.col("duration"))).alias("duration"),
    )
    short_pace = pace.mean_pace(F.col("short_distance"), F.col("short_duration"))
    long_pace = pace.mean_pace(F.col("distance"), F.col("duration"))
    present = F.col("short_duration").isNotNull() & F.col("duration").isNotNull()
    return (
        sums.where(present)
        .withColumn("status", pace.pace_status(short_pace, long_pace))
        .where(F.col("status").isNotNull())
        .select("user", F.col("window.end").alias("window_end"), "status")
    )
