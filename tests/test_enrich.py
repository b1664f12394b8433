import sys
import time

import pytest
from rows import tuples
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace.operators import enrich, words
from millrace.plans import sizing
from millrace.streaming import enrich as streamed
from millrace.streaming import runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = "alpha beta alpha gamma delta beta a a a a aa ab ac ad"


class Recorder:
    """A service that logs its calls and its closing in a folder."""

    def __init__(self, folder):
        self.folder = folder

    def _note(self, kind, text=""):
        (self.folder / f"{kind}-{time.time_ns()}-{id(self)}-{len(text)}").write_text(text)

    def __call__(self, requests):
        self._note("call", " ".join(requests))
        return [len(word) for word in requests]

    def close(self):
        self._note("close")


def recorded(folder, kind="call"):
    return [p.read_text().split() for p in folder.glob(f"{kind}-*")]


@pytest.fixture
def requests(lines):
    return words.tokens(lines((TEXT, 0)), keep=["seq", "ts"])


EXPECTED = sorted((w, len(w)) for w in TEXT.split())


@pytest.mark.parametrize(
    "form",
    [enrich.enrich_each, enrich.enrich_batch, enrich.enrich_batch_sized, enrich.enrich_distinct],
)
def test_every_occurrence_is_answered(requests, form):
    answered = form(requests)
    assert tuples(answered, "word", "length") == EXPECTED
    assert set(answered.columns) == {"seq", "ts", "word", "length"}


def test_one_call_per_row(requests, tmp_path):
    enrich.enrich_each(requests, open_client=lambda: Recorder(tmp_path)).collect()
    assert sorted(recorded(tmp_path)) == sorted([w] for w in TEXT.split())


def test_one_call_per_batch_on_distinct_words(requests, tmp_path):
    one = requests.coalesce(1)
    enrich.enrich_batch(one, open_client=lambda: Recorder(tmp_path)).collect()
    calls = [c for c in recorded(tmp_path) if c]
    assert len(calls) == 1 and sorted(calls[0]) == sorted(set(TEXT.split()))
    assert recorded(tmp_path, "close")


def test_sized_calls_keep_to_their_bucket(requests, tmp_path):
    one = requests.coalesce(1)
    form = enrich.enrich_batch_sized(one, 3, open_client=lambda: Recorder(tmp_path))
    assert tuples(form, "word", "length") == EXPECTED
    for call in recorded(tmp_path):
        assert len(call) <= 3
        assert len({ord(word[0]) % 10 for word in call}) == 1


def test_distinct_requests(requests):
    assert tuples(enrich.distinct_requests(requests), "word") == sorted(
        (w,) for w in set(TEXT.split())
    )


def test_messages(requests):
    sent = enrich.as_messages(enrich.enrich_batch(requests)).where(
        F.col("key") == F.lit("gamma").cast("binary")
    )
    assert sent.head().value.decode() == '{"word":"gamma","length":5}'


def test_sized_stream_answers_full_and_waiting_batches(spark, tmp_path, at):
    rows = [(w, at(i)) for i, w in enumerate(TEXT.split() * 10)]
    source = f"{tmp_path}/in"
    spark.createDataFrame(rows, "word STRING, ts TIMESTAMP").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("word STRING, ts TIMESTAMP").parquet(source)
    answered = streamed.enrich_batch_sized(stream, batch_size=10, max_wait_secs=1, salts=2)
    query = runs.start(
        answered, runs.into_batches(f"{tmp_path}/out"), f"{tmp_path}/cp", interval="1 second"
    )
    try:
        found = []
        for _ in range(60):
            time.sleep(1)
            if query.exception():
                raise query.exception()
            if list((tmp_path / "out").glob("*/_SUCCESS")):
                found = tuples(runs.read_batches(spark, f"{tmp_path}/out", answered), "word", "length")
            if len(found) == len(rows):
                break
    finally:
        query.stop()
    assert found == sorted(EXPECTED * 10)


def refreshed(folder, clock, shown):
    return streamed.RefreshedLookup(
        str(folder),
        load=lambda session, version: session.createDataFrame(
            [(1, f"v{version}")], "customer_id INT, name STRING"
        ),
        max_stale_sec=5,
        sink=lambda batch, batch_id: shown.append(
            [(r.customer_id, r.name, r.version) for r in batch.orderBy("customer_id").collect()]
        ),
        clock=clock,
    )


def test_lookup_is_reloaded_in_a_later_bucket(spark, tmp_path):
    now, shown = [100.0], []
    target = refreshed(tmp_path, lambda: now[0], shown)
    batch = spark.createDataFrame([(1,), (2,)], "customer_id INT")
    for batch_id, clock in enumerate((100.0, 104.9, 105.0, 121.0)):
        now[0] = clock
        target(batch, batch_id)
    assert shown == [[(1, f"v{v}", v), (2, None, None)] for v in (1, 1, 2, 3)]


def test_lookup_goes_on_after_a_restart(spark, tmp_path):
    """A new object has the version of the old one; a repeated batch joins what it joined."""
    batch = spark.createDataFrame([(1,)], "customer_id INT")
    now, shown = [0], []
    for batch_id, clock in [(0, 0), (1, 6), (1, 99), (2, 9), (3, 100), (4, 101)]:
        now[0] = clock
        refreshed(tmp_path, lambda: now[0], shown)(batch, batch_id)
    assert [rows[0][2] for rows in shown] == [1, 2, 2, 2, 3, 3]
    assert sorted(p.name for p in (tmp_path / "lookup").iterdir()) == ["2", "3"]
    assert sorted(p.name for p in (tmp_path / "batch").glob("[0-9]*")) == ["3", "4"]


def test_five_orders_per_firing(spark, tmp_path):
    """Firings go on over batches of any size; a repeated batch fires as it did."""
    table = spark.range(43).selectExpr("id AS order_id", "id % 7 AS customer_id")
    borders = [0, 1, 4, 25, 25, 43]
    for batch_id, (low, high) in enumerate(zip(borders, borders[1:])):
        for chunks in (None, 3):
            target = streamed.PeriodicFirings(
                f"{tmp_path}/state", runs.into_batches(f"{tmp_path}/out"), ["order_id"], 100, 4, chunks=chunks
            )
            target(table.where(f"order_id >= {low} AND order_id < {high}"), batch_id)
    fired = spark.read.parquet(f"{tmp_path}/out/*")
    assert tuples(fired, "order_id", "firing", "timestamp") == [
        (i, i // 5, 100 + i // 5 * 4) for i in range(43)
    ]


def test_side_inputs_are_measured_before_they_grow(spark):
    small = spark.range(100)
    grown = small.select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("n"))
    size = sizing.estimated_bytes(small)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().toString()
    assert hinted(sizing.broadcast_if_small(grown, size * 50, made_from=small, copies=50))
    assert not hinted(sizing.broadcast_if_small(grown, size * 49, made_from=small, copies=50))
