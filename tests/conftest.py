import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def at():
    """Seconds since the epoch as a UTC timestamp."""

    def seconds(value: float) -> datetime:
        return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=value)

    return seconds


@pytest.fixture
def lines(spark, at):
    """(seq, text, ts) rows from (text, seconds) pairs."""

    def build(*pairs):
        rows = [(i, text, at(seconds)) for i, (text, seconds) in enumerate(pairs)]
        return spark.createDataFrame(rows, "seq BIGINT, text STRING, ts TIMESTAMP")

    return build
