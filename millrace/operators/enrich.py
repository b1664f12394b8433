"""Enrichment by calling a service per word, per batch, or per sized batch.

A resolver is ``open() -> client`` and ``client(list of words) -> list of answers``;
the default answers with the word's length.  The client is opened once per task and
closed at its end if it has ``close``.  Words stream through as Arrow batches: no
task holds more than one batch, whatever the size of its partition or bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import first_letter_bucket

Client = Callable[[list[str]], list[int]]


def length_service() -> Client:
    return lambda requests: [len(word) for word in requests]


def _closing(open_client: Callable[[], Client], work) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = open_client()
        try:
            yield from work(client, frames)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()

    return run


def _answered(df: DataFrame, answer: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(answer, T.IntegerType())])


def answer_distinct(client: Client, frame: pd.DataFrame, word: str, answer: str) -> pd.DataFrame:
    """One call on the frame's distinct words, its answers given to every row."""
    unique = frame[word].unique().tolist()
    answers = dict(zip(unique, client(unique))) if unique else {}
    return frame.assign(**{answer: frame[word].map(answers).astype("int32")})


def answer_in_batches(
    client: Client, frame: pd.DataFrame, batch_size: int, word: str, answer: str
) -> pd.DataFrame:
    """One call per ``batch_size`` rows, each on its distinct words."""
    requests, answers = frame[word].tolist(), []
    for start in range(0, len(requests), batch_size):
        batch = requests[start : start + batch_size]
        unique = list(dict.fromkeys(batch))
        given = dict(zip(unique, client(unique)))
        answers.extend(given[w] for w in batch)
    return frame.assign(**{answer: pd.Series(answers, frame.index, dtype="int32")})


def enrich_each(
    words: DataFrame,
    word: str = "word",
    answer: str = "length",
    open_client: Callable[[], Client] = length_service,
) -> DataFrame:
    """One call per row."""

    def work(client: Client, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [client([w])[0] for w in frame[word]]
            yield frame.assign(**{answer: pd.Series(answers, frame.index, dtype="int32")})

    return words.mapInPandas(_closing(open_client, work), _answered(words, answer))


def enrich_batch(
    words: DataFrame,
    word: str = "word",
    answer: str = "length",
    open_client: Callable[[], Client] = length_service,
) -> DataFrame:
    """One call per Arrow batch on its distinct words; other columns pass through."""

    def work(client: Client, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield answer_distinct(client, frame, word, answer)

    return words.mapInPandas(_closing(open_client, work), _answered(words, answer))


def distinct_requests(words: DataFrame, word: str = "word") -> DataFrame:
    return words.select(word).distinct()


def enrich_distinct(
    words: DataFrame,
    word: str = "word",
    answer: str = "length",
    open_client: Callable[[], Client] = length_service,
) -> DataFrame:
    """One answer per distinct word of the whole table, joined back to every row."""
    answers = enrich_batch(distinct_requests(words, word), word, answer, open_client)
    return words.join(answers, word, "left")


def enrich_batch_sized(
    words: DataFrame,
    batch_size: int = 10,
    word: str = "word",
    answer: str = "length",
    open_client: Callable[[], Client] = length_service,
) -> DataFrame:
    """Calls of at most ``batch_size`` rows that share a first-letter bucket.

    Rows wait in their bucket until it has ``batch_size`` of them or the input ends.
    The ten buckets live side by side in every task instead of being ten keys of a
    shuffle, so a frequent first letter costs nothing.
    """
    bucket = first_letter_bucket(F.col(word)).alias("_bucket")
    keyed = words.select("*", bucket)

    def work(client: Client, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, pd.DataFrame] = {}
        for frame in frames:
            for key, rows in frame.groupby("_bucket", sort=False):
                rows = rows.drop(columns="_bucket")
                if key in waiting:
                    rows = pd.concat([waiting.pop(key), rows], ignore_index=True)
                full = len(rows) - len(rows) % batch_size
                if full:
                    yield answer_in_batches(client, rows.iloc[:full], batch_size, word, answer)
                if full < len(rows):
                    waiting[key] = rows.iloc[full:]
        for rows in waiting.values():
            yield answer_in_batches(client, rows, batch_size, word, answer)

    return keyed.mapInPandas(_closing(open_client, work), _answered(words, answer))


def as_messages(answers: DataFrame, columns: Sequence[str] = ("word", "length")) -> DataFrame:
    """Key and JSON value of each answer."""
    return answers.select(
        F.col(columns[0]).cast("binary").alias("key"),
        F.to_json(F.struct(*columns)).cast("binary").alias("value"),
    )
