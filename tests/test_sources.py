import json

from rows import tuples
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.parsing import parse_event_log
from millrace.sources import files, messages
from millrace.streaming import runs

# What the files hold, and how many lines that is.
CONTENTS = {
    "plain.txt": ("one\ntwo\nthree\n", 3),
    "unfinished.txt": ("one\ntwo", 2),
    "windows.txt": ("one\r\ntwo\r\n", 2),
    "old.txt": ("one\rtwo", 2),
    "blank.txt": ("\n\n", 2),
    "empty.txt": ("", 0),
}


def folder(tmp_path):
    for name, (text, _) in CONTENTS.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "hidden.txt").write_text("not seen\n")
    return str(tmp_path)


def test_files_of_one_name_have_ranges_of_their_own(spark, tmp_path):
    for part in ("k=1", "k=2"):
        (tmp_path / part).mkdir()
        (tmp_path / part / "x.txt").write_text("one\ntwo\n")
    ranges = files.file_ranges(spark, str(tmp_path))
    assert tuples(ranges, "name", "start", "end") == [("x.txt", 0, 2)] * 2


def test_file_ranges(spark, tmp_path):
    ranges = files.file_ranges(spark, folder(tmp_path))
    assert tuples(ranges, "name", "start", "end") == sorted(
        (name, 0, n) for name, (_, n) in CONTENTS.items() if n
    )


def test_positions(spark, tmp_path):
    placed = files.list_file_lines(spark, folder(tmp_path))
    expected = sorted((name, i) for name, (_, n) in CONTENTS.items() for i in range(n))
    assert tuples(placed, "name", "position") == expected
    assert ("file: old.txt, position: 1",) in tuples(files.position_lines(placed), "value")


def test_long_ranges_are_cut(spark):
    ranges = spark.createDataFrame([("f", 2, 1003)], "name STRING, start BIGINT, end BIGINT")
    for piece in (1, 7, 1000, 10**6):
        placed = tuples(files.positions(ranges, piece), "position")
        assert placed == [(i,) for i in range(2, 1003)], piece


def test_lines_of_texts(spark):
    table = spark.createDataFrame([(n, t) for n, (t, _) in CONTENTS.items()], "n STRING, t STRING")
    counted = table.select(
        "n",
        tx.line_total(F.col("t")).alias("total"),
        F.size(tx.text_lines(F.col("t"))).alias("size"),
    )
    assert tuples(counted, "n", "total", "size") == sorted(
        (name, n, n) for name, (_, n) in CONTENTS.items()
    )


def test_read_and_write_text(spark, tmp_path):
    files.write_text(spark.createDataFrame([("a b",), ("c",)], "value STRING"), f"{tmp_path}/out")
    assert tuples(files.read_text(spark, f"{tmp_path}/out/*"), "value") == [("a b",), ("c",)]
    files.write_json(spark.range(2), f"{tmp_path}/json")
    assert spark.read.schema("id BIGINT").json(f"{tmp_path}/json").count() == 2


def test_each_header_is_skipped(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("﻿counts\n1\n2\n")
    assert files.read_delimited(spark, str(tmp_path), "counts INT", header=True).count() == 4


def test_watch_directory_sees_each_file_once(spark, tmp_path):
    watched = tmp_path / "in"
    watched.mkdir()
    (watched / "a.txt").write_text("1\n2\n")
    placed = []

    def collect(batch, batch_id):
        placed.append(tuples(files.batch_positions(batch), "name", "position"))

    stream = files.watch_directory(spark, str(watched))
    runs.drain(stream, collect, f"{tmp_path}/cp")
    assert placed[-1] == [("a.txt", 0), ("a.txt", 1)]
    (watched / "b.txt").write_text("3")
    runs.drain(stream, collect, f"{tmp_path}/cp")
    assert placed[-1] == [("b.txt", 0)]
    before = len(placed)
    runs.drain(stream, collect, f"{tmp_path}/cp")
    assert len(placed) == before


LINE = {
    "ip": "1.2.3.4", "id": "7", "lat": 0, "lng": 3.5, "user_agent": "a", "age_bracket": "18-25",
    "opted_into_marketing": True, "http_request": "GET", "http_response": 200,
    "file_size_bytes": 5, "event_datetime": "2022-02-03T04:05:06.007", "event_ts": 1643861106007,
}


def test_message_round_trip(spark, tmp_path, at):
    rows = [(b"", json.dumps({**LINE, "ip": "é"}).encode(), at(5))]
    spark.createDataFrame(rows, messages.MESSAGE).write.parquet(f"{tmp_path}/topic")
    stream = messages.read_message_files(spark, f"{tmp_path}/topic", files_per_trigger=1)
    text = messages.decoded(stream)
    out = messages.passthrough(parse_event_log(text))
    sent = runs.emitted(out).head()
    assert json.loads(sent.key.decode()) == {"event_id": "7", "event_ts": 1643861106007}
    assert json.loads(sent.value.decode()) == {**LINE, "ip": "é", "lat": -1.0, "lng": -1.0}
    assert runs.emitted(text.select(F.unix_seconds("ts").alias("s"))).head().s == 5


def test_messages_without_key(spark):
    rows = spark.createDataFrame([("u", 1.5)], "user STRING, speed DOUBLE")
    sent = messages.to_messages(rows, {"track": "user", "speed": "speed"}).head()
    assert (sent.key, sent.value.decode()) == (b"", '{"track":"u","speed":1.5}')


def test_topic_needs_the_connector(spark):
    try:
        messages.read_topic(spark, "localhost:1", ["t"], "g")
    except Exception as error:
        assert "kafka" in str(error).lower()
