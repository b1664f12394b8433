"""Streams over several files, one per micro-batch, against the bounded forms."""

import os

from rows import tuples
from pyspark.sql import functions as F
from test_tracking import PACE_CASE, metrics_of, pace_status, positions, walk

from millrace.operators import tracking as bounded_tracking
from millrace.operators import sales, traffic
from millrace.operators import words as bounded_words
from millrace.plans import panes
from millrace.streaming import late, runs, tracking, words

SECOND = panes.SECOND
LINE = "seq BIGINT, text STRING, ts TIMESTAMP"


def batches(spark, folder, frames):
    """One parquet file per frame, dated so that they are read in this order."""
    os.makedirs(folder, exist_ok=True)
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{folder}-parts/{i}")
        part = next(
            p for p in os.listdir(f"{folder}-parts/{i}") if p.endswith(".parquet")
        )
        target = f"{folder}/{i}.parquet"
        with open(f"{folder}-parts/{i}/{part}", "rb") as source, open(target, "wb") as sink:
            sink.write(source.read())
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    reader = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(folder)


def line_stream(spark, tmp_path, lines, *groups):
    return batches(spark, str(tmp_path / "lines"), [lines(*group) for group in groups])


def test_running_words_follow_the_bounded_form(spark, tmp_path, lines):
    stream = line_stream(
        spark, tmp_path, lines, [("a", 0)], [("bb", 10)], [("ccc", 20)], [("d", 30)]
    )
    seconds = F.unix_seconds("created_at").alias("s")
    best = runs.emitted(words.running_longest_word(stream).select(seconds, "word"), "update")
    assert tuples(best, "s", "word") == [(0, "a"), (10, "bb"), (20, "ccc"), (30, "ccc")]
    means = runs.emitted(words.running_avg_word_length(stream), "update")
    assert tuples(means, runs.BATCH, "avg_len") == [(0, 1.0), (1, 1.5), (2, 2.0), (3, 1.75)]


def test_unwindowed_counts_accumulate(spark, tmp_path, lines):
    stream = line_stream(spark, tmp_path, lines, [("a b", 0)], [("a", 1)])
    shown = runs.emitted(words.unwindowed_count(stream), "complete")
    assert tuples(shown, runs.BATCH, "word", "n") == [
        (0, "a", 1), (0, "b", 1), (1, "a", 2), (1, "b", 1),
    ]
    assert tuples(runs.latest(shown, ["word"]), "word", "n") == [("a", 2), ("b", 1)]


def test_discarding_counts_forget(spark, tmp_path, lines):
    stream = line_stream(spark, tmp_path, lines, [("a b", 0)], [("a", 1)])
    tokens = bounded_words.tokens(stream)
    sink = words.discarding_count_sink(runs.into_batches(f"{tmp_path}/out"), "word")
    runs.drain(tokens, sink, f"{tmp_path}/cp")
    shown = runs.read_batches(
        spark, f"{tmp_path}/out", tokens.withColumn("n", F.lit(0).cast("bigint"))
    )
    assert tuples(shown, runs.BATCH, "word", "n") == [(0, "a", 1), (0, "b", 1), (1, "a", 1)]


def test_top_k_emits_closed_windows_once(spark, tmp_path, lines):
    stream = line_stream(
        spark, tmp_path, lines, [("a a b", 0), ("c", 3)], [("b b", 9)], [("z", 25)], [("y", 60)]
    )
    counts = words.word_window_counts(stream, 10 * SECOND, delay="1 second")
    sink = words.top_k_sink(1, runs.into_batches(f"{tmp_path}/out"))
    runs.drain(counts, sink, f"{tmp_path}/cp")
    shape = panes.with_bounds(counts).select("window_start", "window_end", "word", "freq")
    shown = runs.read_batches(spark, f"{tmp_path}/out", shape)
    start = F.unix_seconds("window_start")
    assert tuples(shown, start, "word", "freq") == [(0, "b", 3), (20, "z", 1)]


def test_user_counts_drop_rows_behind_the_watermark(spark, tmp_path, at):
    def log(*rows):
        return spark.createDataFrame([(i, at(s)) for i, s in rows], "id STRING, ts TIMESTAMP")

    stream = batches(
        spark, str(tmp_path / "log"),
        [
            log(("u", 1), ("u", 19)), log(("u", 45)), log(("v", 70)), log(("u", 2)),
            log(("u", 200)),
        ],
    )
    counts = traffic.tumble_count_user(stream.withWatermark("ts", "0 seconds"))
    shown = runs.emitted(counts)
    start = F.unix_seconds("window_start")
    assert tuples(shown, "id", start, "page_views") == [("u", 0, 2), ("u", 40, 1), ("v", 60, 1)]


def test_late_split_over_batches(spark, tmp_path, lines):
    stream = line_stream(
        spark, tmp_path, lines,
        [("a", 3)], [("wm", 6.999)], [("b", 4)], [("wm", 7)], [("c", 0)], [("d", 8)],
    )
    split = late.LateSplit(
        f"{tmp_path}/state", 5 * SECOND, 2 * SECOND,
        main=runs.into_batches(f"{tmp_path}/main"),
        droppable=runs.into_batches(f"{tmp_path}/late"),
    )
    runs.drain(stream, split, f"{tmp_path}/cp")
    main = spark.read.parquet(f"{tmp_path}/main")
    start = F.unix_seconds("window_start")
    assert tuples(main.where("text <> 'wm'"), "text", start) == [("a", 0), ("b", 0), ("d", 5)]
    dropped = spark.read.parquet(f"{tmp_path}/late")
    assert tuples(dropped, "text") == [("c",)]
    assert "window_start" not in dropped.columns


def metric_stream(spark, tmp_path, frames, keep_pauses=False):
    stream = batches(spark, str(tmp_path / "positions"), frames)
    folder = f"{tmp_path}/metrics"
    target = tracking.BoxedMetrics(
        f"{tmp_path}/state", runs.into_batches(folder), "seq", keep_pauses
    )
    runs.drain(stream, target, f"{tmp_path}/cp")
    schema = "user STRING, ts TIMESTAMP, distance BIGINT, duration BIGINT"
    reader = spark.readStream.schema(f"{schema}, {runs.BATCH} BIGINT")
    reader = reader.option("basePath", folder)
    return (
        spark.read.schema(schema).parquet(f"{folder}/*"),
        reader.parquet(f"{folder}/{runs.BATCH}=*").drop(runs.BATCH),
    )


def walk_batches(spark, at):
    table = positions(spark, at, sorted(walk(count=300), key=lambda r: r[2]))
    return table, [table.where(f"seq div 110 = {i}") for i in range(3)]


def test_boxed_metrics_over_batches(spark, tmp_path, at):
    table, frames = walk_batches(spark, at)
    written, _ = metric_stream(spark, tmp_path, frames)
    columns = ("user", "ts", "distance", "duration")
    whole = bounded_tracking.boxed_metrics(table, "seq")
    assert tuples(written, *columns) == tuples(whole, *columns)


def test_running_speed_over_batches(spark, tmp_path, at):
    table, frames = walk_batches(spark, at)
    _, stream = metric_stream(spark, tmp_path, frames, keep_pauses=True)
    shown = runs.emitted(tracking.running_track_speed(stream), "update")
    speeds = runs.latest(shown, ["user"])
    expected = bounded_tracking.track_speed(table, "seq")
    assert tuples(speeds, "user", "speed") == tuples(expected, "user", "speed")


def test_motivation_stream(spark, tmp_path, at):
    table = positions(spark, at, PACE_CASE)
    frames = [table.where("seq < 3"), table.where("seq between 3 and 5"), table.where("seq > 5")]
    _, stream = metric_stream(spark, tmp_path, frames)
    for short, long in [(20, 100), (20, 40)]:
        statuses = tracking.motivation(stream, short * SECOND, long * SECOND, "0 seconds")
        shown = runs.latest(runs.emitted(statuses, "update"), ["user", "window_end"])
        assert tuples(shown, "user", "status") == pace_status(PACE_CASE, short, long)


def test_motivation_stream_where_short_windows_do_not_tile_long_ones(spark, tmp_path, at):
    table, frames = walk_batches(spark, at)
    _, stream = metric_stream(spark, tmp_path, frames)
    statuses = tracking.motivation(stream, 30 * SECOND, 70 * SECOND, "0 seconds")
    shown = runs.latest(runs.emitted(statuses, "update"), ["user", "window_end"])
    start = (F.unix_seconds("window_end") - 30).alias("s")
    bounded = bounded_tracking.boxed_metrics(table, "seq")
    whole = bounded_tracking.motivation_cogroup(bounded, 30 * SECOND, 70 * SECOND)
    expected = tuples(whole, "user", F.unix_seconds("window_start"), "status")
    assert tuples(shown, "user", start, "status") == expected and len(expected) > 20


def test_sessions_on_a_stream(spark, tmp_path, at):
    def sold(*rows):
        data = [("a", at(s), 1) for s in rows]
        return spark.createDataFrame(data, "city STRING, ts TIMESTAMP, profit BIGINT")

    frames = [sold(0, 3, 7), sold(20, 22), sold(60), sold(90)]
    stream = batches(spark, str(tmp_path / "sold"), frames).withWatermark("ts", "0 seconds")
    shown = runs.emitted(sales.session_profit(stream, 5 * SECOND))
    start, end = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    assert tuples(shown, start, end, "profit") == [(0, 12, 3), (20, 27, 2), (60, 65, 1)]


def test_triggered_average_over_arrival_time(spark, tmp_path, lines):
    stream = line_stream(spark, tmp_path, lines, [("a bb", 0)], [("ccc", 0)])
    timed = bounded_words.with_arrival_time(stream.drop("ts")).withWatermark("ts", "1 minute")
    shown = runs.emitted(bounded_words.tumble_avg_word_len(timed, panes.DAY), "update")
    assert {r.avg_len for r in shown.collect()} <= {1.5, 2.0, 3.0}
