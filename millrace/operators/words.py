"""Counting, averaging and ranking words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.plans import panes
from millrace.plans.ordered import (
    Chunked,
    Fold,
    chunked,
    fold_max,
    fold_min,
    fold_sum,
    running,
)


def tokens(
    lines: DataFrame,
    column: str = "text",
    pattern: str = tx.ASCII_WORD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per word, with the kept columns of its line."""
    return lines.select(*keep, F.explode(tx.words(F.col(column), pattern)).alias("word"))


def placed_tokens(
    lines: DataFrame,
    column: str = "text",
    pattern: str = tx.ASCII_WORD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """As ``tokens``, with the word's position ``pos`` in its line."""
    found = tx.words(F.col(column), pattern)
    return lines.select(*keep, F.posexplode(found).alias("pos", "word"))


def word_count(
    lines: DataFrame, column: str = "text", pattern: str = tx.ASCII_WORD
) -> DataFrame:
    """Occurrences of each word; partial counts keep frequent words off the shuffle."""
    return tokens(lines, column, pattern).groupBy("word").agg(F.count("*").alias("n"))


def upper_word_count(lines: DataFrame, column: str = "text") -> DataFrame:
    """Word count over upper-cased plain words."""
    upper = tokens(lines, column, tx.PLAIN_WORD).select(F.upper("word").alias("word"))
    return upper.groupBy("word").agg(F.count("*").alias("n"))


def formatted_counts(counts: DataFrame) -> DataFrame:
    return counts.select(tx.count_line(F.col("word"), F.col("n")).alias("value"))


def average(df: DataFrame, value: Column, name: str = "average") -> DataFrame:
    """Mean of a column as one row, NaN when there is nothing to average."""
    totals = df.agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    mean = F.try_divide(F.col("total").cast("double"), F.col("n"))
    return totals.select(F.coalesce(mean, F.lit(float("nan"))).alias(name))


def _length_sums(column: str) -> dict[str, Column]:
    count, length = tx.word_total_and_length(F.col(column))
    return {"word_count": count, "word_chars": length}


def _mean_length() -> Column:
    return F.col("word_chars").cast("double") / F.col("word_count")


def average_word_length(lines: DataFrame, column: str = "text") -> DataFrame:
    """Mean word length as one row; no row at all when there is no word."""
    sums = [F.sum(v).alias(n) for n, v in _length_sums(column).items()]
    return (
        lines.agg(*sums).where(F.col("word_count") > 0).select(_mean_length().alias("avg_len"))
    )


def tumble_avg_word_len(
    lines: DataFrame, width: int = 5 * panes.SECOND, ts: str = "ts", column: str = "text"
) -> DataFrame:
    """Mean word length per tumbling window; windows without words are absent."""
    sums = [F.sum(v).alias(n) for n, v in _length_sums(column).items()]
    totals = panes.with_bounds(lines.groupBy(panes.tumbling(ts, width)).agg(*sums))
    return totals.where(F.col("word_count") > 0).select(
        "window_start", "window_end", _mean_length().alias("avg_len")
    )


def with_arrival_time(lines: DataFrame, ts: str = "ts") -> DataFrame:
    """Processing time as the event time, for windows over arrival."""
    return lines.withColumn(ts, F.current_timestamp())


def sliding_avg_word_len(
    lines: DataFrame,
    size: int = 10 * panes.SECOND,
    period: int = 2 * panes.SECOND,
    ts: str = "ts",
    column: str = "text",
) -> DataFrame:
    """Mean word length per sliding window."""
    totals = panes.sliding_sums(lines, ts, size, period, _length_sums(column))
    return totals.where(F.col("word_count") > 0).select(
        "window_start", "window_end", _mean_length().alias("avg_len")
    )


def tumble_word_total(
    lines: DataFrame, width: int = panes.SECOND, ts: str = "ts", column: str = "text"
) -> DataFrame:
    """Number of words per tumbling window."""
    count, _ = tx.word_total_and_length(F.col(column))
    totals = lines.groupBy(panes.tumbling(ts, width)).agg(F.sum(count).alias("word_count"))
    return panes.with_bounds(totals).where(F.col("word_count") > 0)


def longest_word(lines: DataFrame, column: str = "text") -> DataFrame:
    """The longest word, the alphabetically first of equals; no row without words."""
    best = lines.agg(F.min(tx.longest_in(F.col(column))).alias("best"))
    return best.where(F.col("best").isNotNull()).select(
        F.col("best.word").alias("word"), (-F.col("best.minus_length")).alias("length")
    )


def windowed_word_counts(
    lines: DataFrame, width: int, ts: str = "ts", column: str = "text"
) -> DataFrame:
    words = tokens(lines, column, keep=[ts])
    return words.groupBy(panes.tumbling(ts, width), "word").agg(F.count("*").alias("freq"))


def top_k_words(
    lines: DataFrame,
    width: int = 10 * panes.SECOND,
    k: int = 3,
    ts: str = "ts",
    column: str = "text",
) -> DataFrame:
    """The ``k`` most frequent words of each window, alphabetical among equals.

    The rank filter becomes a per-partition group limit, so only ``k`` rows per
    window and partition are shuffled however many words a window has.
    """
    counts = windowed_word_counts(lines, width, ts, column)
    rank = F.row_number().over(
        Window.partitionBy("window").orderBy(F.desc("freq"), F.asc("word"))
    )
    best = counts.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    return panes.with_bounds(best)


def timed_tokens(
    lines: DataFrame, order: Sequence[str], ts: str = "ts", column: str = "text"
) -> DataFrame:
    """Words with their place and their line's time in microseconds."""
    words = placed_tokens(lines, column, keep=[*order, ts])
    return words.withColumn("_us", panes.micros(F.col(ts)))


def _places(text: Column) -> Column:
    """As many places as a text has words, or more: two words have a mark between them."""
    return F.coalesce(F.shiftright(F.length(text).cast("bigint") + 1, 1), F.lit(0))


def _drawn_places(
    lines: DataFrame, order: Sequence[str], column: str, wanted: int, of: int
) -> DataFrame:
    """Every so many places of each text, without making its words.

    So a text is drawn as often as is due to its length, and a long one is cut inside.
    Cut points beyond a text's last word stand for its end.
    """
    step = F.lit(max(of // wanted, 1)).cast("bigint")
    first = F.pmod(F.xxhash64(*order), step)
    last = _places(F.col(column)) - 1
    some = F.when(first <= last, F.sequence(first, last, step))
    drawn = lines.select(*order, F.explode(some).alias("pos"))
    return drawn.withColumn("pos", F.col("pos").cast("int")).na.drop().distinct()


def _arrivals(
    lines: DataFrame, order: Sequence[str], ts: str, column: str, chunks: int | None
) -> Chunked:
    return chunked(
        timed_tokens(lines, order, ts, column),
        [*order, "pos"],
        chunks=chunks,
        sample_from=lines,
        draw=lambda wanted, of: _drawn_places(lines, order, column, wanted, of),
        total=F.sum(_places(F.col(column))),
    )


def longest_folds() -> dict[str, Fold]:
    """The best word and the latest time of words in their order."""
    return {
        "best": fold_min(tx.longest_first(F.col("word"))),
        "latest": fold_max(F.col("_us")),
    }


def average_folds() -> dict[str, Fold]:
    """Sums of lengths and words, and the latest time, of words in their order."""
    return {
        "word_chars": fold_sum(F.length("word").cast("bigint")),
        "word_count": fold_sum(F.lit(1).cast("bigint")),
        "latest": fold_max(F.col("_us")),
    }


def running_longest_word(
    lines: DataFrame,
    order: Sequence[str],
    ts: str = "ts",
    column: str = "text",
    chunks: int | None = None,
    start: dict[str, Column] | None = None,
) -> DataFrame:
    """After each word: the longest word so far, and the latest timestamp so far.

    ``start`` has the folds of words before these.
    """
    parts = _arrivals(lines, order, ts, column, chunks)
    best = running(parts, longest_folds(), start=start)
    return best.select(
        *order,
        "pos",
        panes.from_micros(F.col("latest")).alias("created_at"),
        F.col("best.word").alias("word"),
    )


def with_final_pane(panes_so_far: DataFrame, order: Sequence[str]) -> DataFrame:
    """Repeat the last result once, as the closing of the global window does."""
    last = panes_so_far.orderBy(*[F.desc(c) for c in [*order, "pos"]]).limit(1)
    return panes_so_far.unionByName(last)


def running_avg_word_length(
    lines: DataFrame,
    order: Sequence[str],
    ts: str = "ts",
    column: str = "text",
    chunks: int | None = None,
    start: dict[str, Column] | None = None,
) -> DataFrame:
    """After each word: the mean length so far, and the latest timestamp so far.

    ``start`` has the folds of words before these.
    """
    parts = _arrivals(lines, order, ts, column, chunks)
    sums = running(parts, average_folds(), start=start)
    return sums.select(
        *order,
        "pos",
        panes.from_micros(F.col("latest")).alias("created_at"),
        _mean_length().alias("avg_len"),
    )
