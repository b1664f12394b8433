import math
import random

import pytest
from rows import tuples
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.dates import rfc3339
from millrace.operators import words
from millrace.plans import panes


# The expected results of one-letter to four-letter arrivals.
def test_running_longest_word(lines, at):
    arrivals = lines(("a", 0), ("bb", 10), ("ccc", 20), ("d", 30))
    so_far = words.running_longest_word(arrivals, ["seq"])
    shown = words.with_final_pane(so_far, ["seq"]).withColumn("s", F.unix_seconds("created_at"))
    assert tuples(shown, "s", "word") == [
        (0, "a"), (10, "bb"), (20, "ccc"), (30, "ccc"), (30, "ccc"),
    ]


def test_running_average_word_length(lines):
    arrivals = lines(("a", 0), ("bb", 0), ("ccc", 0))
    so_far = words.running_avg_word_length(arrivals, ["seq"])
    assert tuples(so_far, "seq", "avg_len") == [(0, 1.0), (1, 1.5), (2, 2.0)]


def test_running_words_over_many_chunks(spark, lines):
    texts = [(f"w{'x' * (i * 7 % 11)} b{'y' * (i * 5 % 13)}", i) for i in range(600)]
    arrivals = lines(*texts)
    chunked = words.running_longest_word(arrivals, ["seq"], chunks=8)
    whole = words.running_longest_word(arrivals, ["seq"], chunks=1000)
    assert tuples(chunked, "seq", "pos", "word") == tuples(whole, "seq", "pos", "word")
    means = words.running_avg_word_length(arrivals, ["seq"], chunks=8)
    length, count, expected = 0, 0, []
    for i, (text, _) in enumerate(texts):
        for pos, word in enumerate("".join(c if c.isalpha() else " " for c in text).split()):
            length, count = length + len(word), count + 1
            expected.append((i, pos, length / count))
    assert tuples(means, "seq", "pos", "avg_len") == expected


def test_sliding_average_word_length(lines):
    rows = lines(("a", 0), ("bb", 1.99), ("ccc", 5), ("dddd", 10))
    shown = words.sliding_avg_word_len(rows)
    values = [1.5, 1.5, 2.0, 2.0, 2.0, 3.5, 3.5, 4.0, 4.0, 4.0]
    starts = F.unix_seconds("window_start").alias("s")
    ends = F.unix_seconds("window_end").alias("e")
    assert tuples(shown, starts, ends, "avg_len") == [
        (2 * i - 8, 2 * i + 2, v) for i, v in enumerate(values)
    ]


def test_sliding_panes_equal_built_in_window(spark, lines):
    rows = lines(*[("word " * (i % 5 + 1), i * 1.7) for i in range(200)])
    sums = {"n": F.size(tx.words(F.col("text"))).cast("bigint")}
    for size, period in [(10, 2), (10, 3), (7, 7), (9, 6)]:
        ours = panes.sliding_sums(rows, "ts", size * panes.SECOND, period * panes.SECOND, sums)
        window = F.window("ts", f"{size} seconds", f"{period} seconds")
        plain = panes.with_bounds(rows.groupBy(window).agg(F.sum(sums["n"]).alias("n")))
        columns = ("window_start", "window_end", "n")
        assert tuples(ours, *columns) == tuples(plain, *columns), (size, period)


def test_windows_with_gaps_between_them(lines):
    rows = lines(("a", 3), ("a", 4), ("a", 13.9), ("a", 19), ("a", -6.5))
    sums = {"n": F.lit(1).cast("bigint")}
    shown = panes.sliding_sums(rows, "ts", 4 * panes.SECOND, 10 * panes.SECOND, sums)
    start, end = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    assert tuples(shown, start, end, "n") == [(-10, -6, 1), (0, 4, 1), (10, 14, 1)]


def test_top_k_words(lines):
    texts = [("pear fig fig plum", 3), ("fig kiwi pear plum", 9.5), ("plum lime kiwi kiwi", 14)]
    shown = words.top_k_words(lines(*texts), 10 * panes.SECOND, 3)
    expected = []
    for start in (0, 10):
        held = [w for text, s in texts if start <= s < start + 10 for w in text.split()]
        ranked = sorted({(-held.count(w), w) for w in held})[:3]
        expected += [(start, w, -n) for n, w in ranked]
    assert tuples(shown, F.unix_seconds("window_start"), "word", "freq") == sorted(expected)


def test_tokenizers(spark):
    df = spark.createDataFrame([("don't éa b1_c",)], "text STRING")
    found = df.select(
        tx.words(F.col("text")).alias("a"),
        tx.words(F.col("text"), tx.UNICODE_WORD).alias("u"),
        tx.words(F.col("text"), tx.PLAIN_WORD).alias("p"),
    ).head()
    assert found.a == ["don't", "a", "b", "c"]
    assert found.u == ["don't", "éa", "b1_c"]
    assert found.p == ["don", "t", "éa", "b1_c"]


def test_averages_of_nothing(spark, lines):
    numbers = spark.createDataFrame([(x,) for x in (4, 11, 2, 40, 1, 8)], "x INT")
    assert words.average(numbers, F.col("x")).head()[0] == 11.0
    assert math.isnan(words.average(numbers.where("x > 99"), F.col("x")).head()[0])
    assert words.average_word_length(lines(("4 5,6", 0))).collect() == []
    assert words.average_word_length(lines(("a bb", 0))).head()[0] == 1.5


def test_longest_word(lines):
    assert tuple(words.longest_word(lines(("zz aa", 0), ("b yy", 0))).head()) == ("aa", 2)
    assert words.longest_word(lines(("1 2", 0))).collect() == []


def test_counts_and_formats(lines):
    rows = lines(("b a a'", 0), ("a 'b", 1))
    assert tuples(words.word_count(rows), "word", "n") == [("'b", 1), ("a", 2), ("a'", 1), ("b", 1)]
    assert tuples(words.upper_word_count(lines(("ab Ab", 0))), "word", "n") == [("AB", 2)]
    counts = words.formatted_counts(words.word_count(lines(("x x", 0))))
    assert tuples(counts, "value") == [("x: 2",)]


def test_tumbling_words(lines):
    rows = lines(("a bb", 0), ("ccc", 4.9), ("!", 7), ("dddd", 12))
    start = F.unix_seconds("window_start")
    assert tuples(words.tumble_avg_word_len(rows), start, "avg_len") == [(0, 2.0), (10, 4.0)]
    totals = words.tumble_word_total(rows)
    assert tuples(totals, start, "word_count") == [(0, 2), (4, 1), (12, 1)]


def test_arrival_time_windows(spark, lines):
    timed = words.with_arrival_time(lines(("a bb", 0), ("ccc", 100)).drop("ts"))
    assert [r.avg_len for r in words.tumble_avg_word_len(timed, panes.DAY).collect()] == [2.0]


@pytest.mark.parametrize(
    "seconds, text",
    [(0, "1970-01-01T00:00:00Z"), (1.99, "1970-01-01T00:00:01.990000Z")],
)
def test_rfc3339(spark, at, seconds, text):
    df = spark.createDataFrame([(at(seconds),)], "ts TIMESTAMP")
    assert df.select(rfc3339(F.col("ts"))).head()[0] == text


def test_first_letter_bucket(spark):
    df = spark.createDataFrame([("apple",), ("'t",)], "w STRING")
    buckets = [r[0] for r in df.select(tx.first_letter_bucket(F.col("w"))).collect()]
    assert buckets == [ord("a") % 10, ord("'") % 10]


def test_a_long_text_is_cut_inside(spark, at):
    """One text with most of all words spans several chunks, and nothing changes."""
    rng = random.Random(3)
    texts = ["a bb", "", " ".join("w" * rng.randrange(1, 9) for _ in range(20_000)), "ccc", None, "12 34"]
    rows = [(i, text, at(i)) for i, text in enumerate(texts)]
    lines = spark.createDataFrame(rows, "seq BIGINT, text STRING, ts TIMESTAMP")
    parts = words._arrivals(lines, ["seq"], "ts", "text", 16)
    sizes = [r["count"] for r in parts.rows.where("seq = 2").groupBy("_chunk").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 8_000
    by_default = ordered_rows(words.running_avg_word_length(lines, ["seq"]))
    assert ordered_rows(words.running_avg_word_length(lines, ["seq"], chunks=16)) == by_default
    best = ordered_rows(words.running_longest_word(lines, ["seq"]))
    assert ordered_rows(words.running_longest_word(lines, ["seq"], chunks=16)) == best
    assert len(best) == 20_003


def ordered_rows(df):
    return sorted(map(tuple, df.collect()))


def test_texts_are_drawn_by_their_length(spark, at):
    rows = [(i, "x " * (10 if i else 5000), at(i)) for i in range(500)]
    lines = spark.createDataFrame(rows, "seq BIGINT, text STRING, ts TIMESTAMP")
    drawn = words._drawn_places(lines, ["seq"], "text", 1, 50)
    assert 70 <= drawn.where("seq = 0").count() <= 130
    assert 60 <= drawn.where("seq > 0").count() <= 140
