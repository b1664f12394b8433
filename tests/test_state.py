"""Targets that carry state over micro-batches, against the bounded operators."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import tuples
from test_tracking import positions, walk

from millrace.operators import sales as bounded_sales
from millrace.operators import tracking as bounded_tracking
from millrace.operators import words as bounded_words
from millrace.plans import panes
from millrace.sources import messages
from millrace.streaming import runs, sales, tracking, words
from millrace.streaming.state import ChangeLog, Seen

SECOND, DAY = panes.SECOND, panes.DAY
STATE = T.StructType([T.StructField("user", T.StringType()), T.StructField("spot", T.IntegerType())])


def size(folder):
    return sum(
        os.path.getsize(os.path.join(top, name))
        for top, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    )


def names(folder):
    """Without the checksums that a local file system keeps beside its files."""
    return sorted(name for name in os.listdir(folder) if not name.startswith("."))


def cut(table, by, borders):
    """The rows of a table between given values of a column."""
    borders = [None, *borders, None]
    for low, high in zip(borders, borders[1:]):
        some = table
        if low is not None:
            some = some.where(F.col(by) >= low)
        yield some if high is None else some.where(F.col(by) < high)


# The log of changes.


def history(spark, folder, batches, every):
    log = ChangeLog(folder, STATE, ["user"], every)
    expected, states = {}, []
    for batch_id, (changed, gone) in enumerate(batches):
        log.record(
            batch_id,
            spark.createDataFrame(changed, STATE),
            spark.createDataFrame([(g, None) for g in gone], STATE) if gone else None,
        )
        expected = {k: v for k, v in (expected | dict(changed)).items() if k not in gone}
        states.append(expected)
    return log, states


@pytest.mark.parametrize("every", [1, 3, 10])
def test_change_log_replays_the_last_batches(spark, tmp_path, every):
    rng = random.Random(every)
    batches = [
        ([(f"u{u}", rng.randrange(99)) for u in rng.sample(range(8), 3)], [f"u{8 + i % 2}"] * (i % 3 == 0))
        for i in range(9)
    ]
    log, states = history(spark, str(tmp_path), batches, every)
    assert log.newest(spark) == 8
    for batch_id in range(max(0, 9 - every), 9):
        again = ChangeLog(str(tmp_path), STATE, ["user"], every)
        found = dict(map(tuple, again.after(spark, batch_id).collect()))
        assert found == states[batch_id]
    kept = {int(n) for n in os.listdir(tmp_path / "changes")}
    assert len(kept) <= 2 * every and max(kept) == 8


def test_change_log_repeats_a_batch(spark, tmp_path):
    log, _ = history(spark, str(tmp_path), [([("a", 1)], []), ([("b", 2)], [])], every=2)
    log.record(1, spark.createDataFrame([("b", 3), ("c", 4)], STATE))
    assert tuples(log.after(spark, 1), "user", "spot") == [("a", 1), ("b", 3), ("c", 4)]
    assert tuples(log.before(spark, 1), "user", "spot") == [("a", 1)]
    assert log.before(spark, 0).collect() == []


def test_bytes_follow_the_changed_keys(spark, tmp_path):
    many = spark.range(20_000).selectExpr("concat('user', id) AS user", "int(id) AS spot")
    log = ChangeLog(str(tmp_path), STATE, ["user"], every=100)
    log.record(0, many)
    log.record(1, spark.createDataFrame([("user5", 7)], STATE))
    assert size(tmp_path / "changes/1") < size(tmp_path / "changes/0") / 20
    assert log.after(spark, 1).where("user = 'user5'").head().spot == 7
    assert log.after(spark, 1).count() == 20_000


def test_seen_keeps_the_latest_time(spark, tmp_path, at):
    seen = Seen(str(tmp_path))
    times = [[5.0], [], [3.0, None], [9.0]]
    for batch_id, some in enumerate(times):
        rows = spark.createDataFrame([(None if t is None else at(t),) for t in some], "ts TIMESTAMP")
        seen.record(rows, batch_id)
    assert [seen.before(spark, i) for i in (3, 4)] == [5 * SECOND, 9 * SECOND]
    assert names(tmp_path) == ["2", "3"]


# Panes of a number of sales.


def sold(spark, rows=400):
    """Most sales in one city, some without a city."""
    rng = random.Random(7)
    data = [
        (rng.choice(["hot"] * 7 + ["a", "b", None]), i, rng.randrange(-50, 90)) for i in range(rows)
    ]
    return spark.createDataFrame(data, "city STRING, id BIGINT, profit BIGINT")


@pytest.mark.parametrize(
    ("borders", "chunks"), [([], None), ([1, 3, 7, 350], None), ([150], 6), (range(40, 400, 40), None)]
)
def test_count_panes_equal_the_bounded_form(spark, tmp_path, borders, chunks):
    table = sold(spark)
    shown = f"{tmp_path}/shown"
    for batch_id, batch in enumerate(cut(table, "id", borders)):
        # A new object each time, as after a restart; every third batch runs twice.
        for _ in range(1 + (batch_id % 3 == 1)):
            target = sales.CountPanes(
                f"{tmp_path}/state", runs.into_batches(shown), ["id"], chunks=chunks, compact_every=4
            )
            target(batch, batch_id)
    columns = ("city", "pane", "sales", "profit")
    fired = spark.read.parquet(f"{shown}/*").select(*columns)
    closing = target.closing(spark, table)
    assert fired.where("sales <> 5").count() == 0 and closing.where("sales >= 5").count() == 0
    expected = bounded_sales.global_count_discarding(table, ["id"])
    key = F.coalesce("city", F.lit("-"))
    assert tuples(fired.unionByName(closing), key, *columns[1:]) == tuples(expected, key, *columns[1:])


# Windows that fire again.


def test_every_pane_of_a_window(spark, tmp_path, at):
    batches = [
        [("x", 1, 10), ("x", 11, 1), ("y", 2, 5)],
        [("x", 3, 20), ("x", 9.5, 30)],
        [("x", 4, 7), ("y", 12, 2)],
        [("x", 6, 1), ("y", 3, 50)],
        [("x", 7, 100), ("x", 13, 4)],
        [(None, 14, 9), ("x", None, 9)],
    ]
    shown = f"{tmp_path}/shown"
    for batch_id, rows in enumerate(batches):
        data = [(c, None if s is None else at(s), p) for c, s, p in rows]
        batch = spark.createDataFrame(data, "city STRING, ts TIMESTAMP, profit BIGINT")
        for _ in range(2):
            target = sales.AccumulatingPanes(
                f"{tmp_path}/state", runs.into_batches(shown), 10 * SECOND, 2 * SECOND, compact_every=2
            )
            target(batch, batch_id)
    found = runs.read_batches(spark, shown, target.shape(batch))
    start = F.unix_seconds("window_start")
    # After the first batch the latest time is 11, which closes [0, 10); after the third 12 ends it.
    assert tuples(found.where("city = 'x'"), runs.BATCH, start, "pane", "timing", "profit") == [
        (0, 0, 0, "early", 10),
        (0, 10, 0, "early", 1),
        (1, 0, 1, "on time", 60),
        (2, 0, 2, "late", 67),
        (4, 10, 1, "early", 5),
    ]
    assert tuples(found.where("city = 'y'"), runs.BATCH, start, "pane", "timing", "profit") == [
        (0, 0, 0, "early", 5),
        (2, 10, 0, "early", 2),
    ]
    assert tuples(found.where("city IS NULL"), start, "profit") == [(10, 9)]


# Positions in the order of their times.


def metrics(spark, folder, batches, **options):
    for batch_id, batch in enumerate(batches):
        target = tracking.BoxedMetrics(
            f"{folder}/state", runs.into_batches(f"{folder}/out"), "seq", compact_every=3, **options
        )
        target(batch, batch_id)
    return spark.read.parquet(f"{folder}/out/*")


COLUMNS = ("user", "ts", "distance", "duration")


def shuffled(spark, at, table, jitter, batches):
    """Batches in which rows stand up to ``jitter`` seconds from their times' order."""
    rng = random.Random(2)
    rows = sorted(table.collect(), key=lambda r: r.ts.timestamp() + rng.uniform(0, jitter))
    share = -(-len(rows) // batches)
    frames = [
        spark.createDataFrame(rows[i : i + share], table.schema) for i in range(0, len(rows), share)
    ]
    end = [("nobody", 0, at(10_000_000), 10_000_000)]
    closing = spark.createDataFrame(end, table.schema.simpleString()[7:-1].replace(":", " "))
    return [*frames, closing]


@pytest.mark.parametrize("keep_pauses", [False, True])
def test_shuffled_positions_give_the_bounded_metrics(spark, tmp_path, at, keep_pauses):
    table = positions(spark, at, sorted(walk(count=300), key=lambda r: r[2]))
    span = table.agg(F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))).head()[0]
    jitter = span / 4
    batches = shuffled(spark, at, table, jitter, 6)
    plain = metrics(spark, f"{tmp_path}/a", batches, keep_pauses=keep_pauses)
    found = metrics(
        spark, f"{tmp_path}/b", batches, keep_pauses=keep_pauses, delay=int(jitter + 1) * SECOND
    )
    if keep_pauses:
        speeds = tracking.running_track_speed(found).where("user <> 'nobody'")
        expected = bounded_tracking.track_speed(table, "seq")
        assert tuples(speeds, "user", "speed") == tuples(expected, "user", "speed")
    else:
        expected = tuples(bounded_tracking.boxed_metrics(table, "seq"), *COLUMNS)
        assert tuples(found, *COLUMNS) == expected
        assert tuples(plain, *COLUMNS) != expected


def test_positions_after_the_watermark_are_late(spark, tmp_path, at):
    table = positions(spark, at, [("u", 0, 1), ("u", 4, 10), ("u", 7, 5), ("u", 9, 12), ("u", 1, 13)])
    late = []
    order = [[0], [1], [2, 3], [4]]
    batches = [table.where(F.col("seq").isin(some)) for some in order]
    found = metrics(
        spark, str(tmp_path), batches,
        late=lambda rows, batch_id: late.extend((batch_id, r.spot) for r in rows.collect()),
    )
    assert late == [(2, 7)]
    assert tuples(found, "distance", "duration") == [(4, 9 * SECOND), (5, 2 * SECOND), (8, SECOND)]


def test_a_restarted_run_gives_the_same_metrics(spark, tmp_path, at):
    table = positions(spark, at, sorted(walk(count=200), key=lambda r: r[2]))
    batches = shuffled(spark, at, table, 50, 8)
    whole = metrics(spark, f"{tmp_path}/a", batches, delay=60 * SECOND)
    folder = f"{tmp_path}/b"
    for batch_id in (0, 1, 2, 2, 3, 4, 5, 5, 6, 7, 8):
        target = tracking.BoxedMetrics(
            f"{folder}/state", runs.into_batches(f"{folder}/out"), "seq", delay=60 * SECOND
        )
        if batch_id < len(batches):
            target(batches[batch_id], batch_id)
    assert tuples(spark.read.parquet(f"{folder}/out/*"), *COLUMNS) == tuples(whole, *COLUMNS)


# Words one by one.


@pytest.mark.parametrize("name", ["LONGEST", "AVERAGE"])
def test_running_words_give_every_row(spark, tmp_path, at, name):
    rng = random.Random(9)
    data = [
        (i, " ".join(rng.choices(["a", "bb", "ccc", "dddddd", "e'f", "", "12"], k=rng.randrange(9))), at(i * 7 % 50))
        for i in range(40)
    ]
    table = spark.createDataFrame([*data, (40, None, at(99))], "seq BIGINT, text STRING, ts TIMESTAMP")
    result = getattr(words.RunningWords, name)
    shown = f"{tmp_path}/shown"
    for batch_id, batch in enumerate(cut(table, "seq", [0, 5, 6, 30])):
        for _ in range(1 + batch_id % 2):
            target = words.RunningWords(
                f"{tmp_path}/state", runs.into_batches(shown), ["seq"], result, chunks=batch_id + 1
            )
            target(batch, batch_id)
    expected = result[0](table, ["seq"])
    found = spark.read.parquet(f"{shown}/*")
    assert tuples(found, *expected.columns) == tuples(expected, *expected.columns)
    assert len(names(f"{tmp_path}/state")) == 2
    tokens = bounded_words.tokens(table)
    assert expected.count() == tokens.count()


# Messages.


def test_messages_are_seen_once(spark, tmp_path):
    log = messages.MessageLog(str(tmp_path))
    assert log.received(spark).collect() == []

    def batch(*texts):
        rows = [(b"k", t.encode()) for t in texts]
        return spark.createDataFrame(rows, "key BINARY, value BINARY")

    log(batch("a", "a", "b"), 0)
    log.append(batch("c"), 1)  # broken off
    log(batch("c", "d"), 1)
    log(batch("d", "c"), 1)  # sent again in another order
    log(batch(), 2)
    found = log.received(spark).select(F.col("value").cast("string"), "batch_id")
    assert tuples(found, "value", "batch_id") == [("a", 0), ("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    sent = spark.read.parquet(f"{tmp_path}/messages")
    assert sent.count() == 8


def test_a_failed_sink_is_run_again(spark, tmp_path):
    """The stream breaks off after its second batch was sent, and starts again."""
    source = f"{tmp_path}/in"
    rows = spark.range(40).selectExpr("CAST('k' AS BINARY) AS key", "CAST(string(id) AS BINARY) AS value")
    for i in range(4):
        rows.where(f"int(string(value)) % 4 = {i}").coalesce(1).write.mode("append").parquet(source)
    log = messages.MessageLog(f"{tmp_path}/topic")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def failing(batch, batch_id):
        log(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        runs.drain(stream, failing, f"{tmp_path}/checkpoint")
    runs.drain(stream, log, f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/topic/messages").count() == 50
    found = log.received(spark).select(F.col("value").cast("string").cast("int").alias("n"))
    assert tuples(found, "n") == [(i,) for i in range(40)]
