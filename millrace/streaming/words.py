"""Word streams."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text as tx
from millrace.operators import words as bounded
from millrace.plans import panes
from millrace.streaming.runs import PerBatch
from millrace.streaming.state import Note


def running_longest_word(lines: DataFrame, ts: str = "ts", column: str = "text") -> DataFrame:
    """Longest word and latest timestamp so far; in update mode, one row per trigger.

    These are the rows of the bounded form at the ends of the micro-batches.  The
    closing repetition of the last row does not exist on a stream.
    """
    best = F.min(tx.longest_in(F.col(column))).alias("best")
    sums = lines.groupBy().agg(best, F.max(ts).alias("created_at"))
    return sums.select("created_at", F.col("best.word").alias("word"))


def running_avg_word_length(
    lines: DataFrame, ts: str = "ts", column: str = "text"
) -> DataFrame:
    """Mean word length and latest timestamp so far; in update mode."""
    count, length = tx.word_total_and_length(F.col(column))
    sums = lines.groupBy().agg(
        F.sum(count).alias("n"), F.sum(length).alias("chars"), F.max(ts).alias("created_at")
    )
    mean = F.try_divide(F.col("chars").cast("double"), F.col("n"))
    return sums.select("created_at", mean.alias("avg_len"))


def _literal(value: Any, kind: T.DataType) -> Column:
    """A noted value as a constant column."""
    if value is not None and isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


class RunningWords:
    """A ``foreachBatch`` target with a row per word: the result so far after each.

    Within a batch the bounded operator runs, in chunks; it starts from the fold of all
    batches before, one row that is written per batch id, of which the last two are kept.
    The closing repetition of the last row does not exist on a stream.
    """

    LONGEST = (bounded.running_longest_word, bounded.longest_folds)
    AVERAGE = (bounded.running_avg_word_length, bounded.average_folds)

    def __init__(
        self,
        state_folder: str,
        sink: PerBatch,
        order: Sequence[str],
        result: tuple = LONGEST,
        ts: str = "ts",
        column: str = "text",
        chunks: int | None = None,
    ):
        self.note, self.sink, self.order = Note(state_folder), sink, list(order)
        self.operator, self.folds = result
        self.ts, self.column, self.chunks = ts, column, chunks

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self._extend(batch, batch_id)
        finally:
            batch.unpersist()

    def _extend(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folds = self.folds()
        words = bounded.timed_tokens(batch, self.order, self.ts, self.column)
        whole = words.agg(*[f.aggregate(f.value).alias(n) for n, f in folds.items()])
        start, before = None, self.note.of(spark, batch_id - 1)
        if before is not None:
            start = {f.name: _literal(before[f.name], f.dataType) for f in whole.schema}
            whole = whole.select(
                *[
                    F.coalesce(fold.combine(start[n], F.col(n)), F.col(n), start[n]).alias(n)
                    for n, fold in folds.items()
                ]
            )
        shown = self.operator(
            batch, self.order, self.ts, self.column, self.chunks, start=start
        )
        self.sink(shown, batch_id)
        self.note.record(spark, batch_id, whole.head().asDict(recursive=True))


def unwindowed_count(lines: DataFrame, column: str = "text") -> DataFrame:
    """Counts since the start, without a window; for complete mode."""
    return bounded.word_count(lines, column)


def word_window_counts(
    lines: DataFrame,
    width: int,
    delay: str,
    ts: str = "ts",
    column: str = "text",
) -> DataFrame:
    """Counts per window and word, for append mode."""
    watched = lines.withWatermark(ts, delay)
    return bounded.windowed_word_counts(watched, width, ts, column)


def top_k_sink(k: int, sink: PerBatch) -> PerBatch:
    """Rank the counts of the windows that a batch closed.

    In append mode all counts of a window are emitted in the batch in which the
    watermark passes its end, so the ranking within the batch is final.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        by_count = Window.partitionBy("window").orderBy(F.desc("freq"), F.asc("word"))
        best = batch.withColumn("rank", F.row_number().over(by_count))
        sink(panes.with_bounds(best.where(F.col("rank") <= k).drop("rank")), batch_id)

    return write


def discarding_count_sink(sink: PerBatch, *keys: Column | str) -> PerBatch:
    """Counts of each micro-batch alone: a firing that forgets what it emitted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch.groupBy(*keys).agg(F.count("*").alias("n")), batch_id)

    return write
