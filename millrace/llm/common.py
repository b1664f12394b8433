"""What several operators need: words as columns, written tables, shared files."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from dataclasses import dataclass
from types import ModuleType

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.shared import shared_folder

# Words are runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("bigint")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    This cuts the lineage, so that later stages neither repeat the work nor depend on
    executors that may be lost.  ``release`` removes the tables of this process.
    """
    return stored(df, purpose).rows


@dataclass(frozen=True)
class Stored:
    """A written table; ``discard`` removes it when nothing will read it any more."""

    rows: DataFrame
    path: str

    def discard(self) -> None:
        if self.path in _written:
            _written.remove(self.path)
            _remove(self.path)


def stored(df: DataFrame, purpose: str) -> Stored:
    """As ``written``, for tables that the caller removes itself."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    _written.append(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def arrow_map(df: DataFrame, function, schema, records: int = 1000, keeps: str = "") -> DataFrame:
    """``mapInArrow`` in batches of few rows and bytes, however long the texts are.

    The settings are the session's, since a plan takes them when it runs.  Workers live
    on after a task, so what it has freed goes back to the system; what the tasks before
    it held is part of cycles with their functions.  Of what earlier functions have
    ``kept`` in a worker only the object named ``keeps`` stays.
    """

    def run(batches):
        forget(keeps)
        yield from function(batches)
        gc.collect()
        trim()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)
    return df.mapInArrow(run, schema)


def kept(name: str, make):
    """The object of that name of this process, made once.

    Tasks get the modules by value, so what a module holds ends with its task.
    """
    place = sys.modules.setdefault("millrace_kept", ModuleType("millrace_kept"))
    if not hasattr(place, name):
        setattr(place, name, make())
    return getattr(place, name)


def forget(but: str = "") -> None:
    """Drop what this process has kept, but for the object of that name."""
    place = sys.modules.get("millrace_kept", ModuleType("millrace_kept"))
    for name in [x for x in vars(place) if not x.startswith("__") and x != but]:
        delattr(place, name)
        gc.collect()
        trim()


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared folder, for files that tasks write themselves."""
    path = shared_folder(spark, purpose)
    _written.append(path)
    system, inner = opened(path)
    system.create_dir(inner, recursive=True)
    return path


def release() -> None:
    """Remove the tables and files that this process has written so far.

    Results that read them must have been consumed before.
    """
    while _written:
        _remove(_written.pop())


def _remove(path: str) -> None:
    system, inner = opened(path)
    with contextlib.suppress(FileNotFoundError):
        system.delete_dir(inner)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def put_file(path: str, data: bytes) -> None:
    """Write a file as a whole: a repeated or lost task never leaves half of one."""
    import uuid

    system, inner = opened(path)
    draft = f"{inner}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, inner)
