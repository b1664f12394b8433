"""The work folder that every executor can see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``.

    The cluster names that folder.  Only a local session, whose executors share
    this machine's disk, may go without one; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder shared by all executors"
            )
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, as Spark's own readers find it, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, place = _file_system(spark, folder)
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it, if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: readers find all of it or none."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    system, place = _file_system(spark, draft)
    out = system.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()
    remove(spark, path)
    system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(path))


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or null if there is none."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def date_files(spark: SparkSession, folder: str, millis: int) -> None:
    """Set the modification time of all files of a folder."""
    system, place = _file_system(spark, folder)
    for found in system.listStatus(place):
        system.setTimes(found.getPath(), millis, -1)
