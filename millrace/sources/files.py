"""Text files, their line ranges, and watched folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import line_total

PIECE = 1_000_000

# Schemas of the delimited inputs.
STAFF = "id STRING, name STRING, dept_no INT, dept STRING, date STRING"
LOCATION = "id STRING, phone STRING, city STRING"
CARDS = (
    "customer_id STRING, first_name STRING, last_name STRING, relationship_id STRING, "
    "card_type STRING, max_limit INT, spent INT, cash_withdrawn INT, "
    "payment_cleared INT, payment_date STRING"
)
LOANS = (
    "customer_id STRING, first_name STRING, last_name STRING, occupation STRING, "
    "loan_id STRING, loan_type STRING, due_date STRING, amount INT, payment_date STRING"
)
SALES = (
    "store_id STRING, city STRING, product_id STRING, category STRING, pieces INT, "
    "buy_rate INT, sell_price INT, unix_timestamp BIGINT"
)


def read_text(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per line of the matching files, as ``value``."""
    return spark.read.text(pattern)


def read_delimited(
    spark: SparkSession, pattern: str, schema: str | T.StructType, header: bool = False
) -> DataFrame:
    """Comma-separated files with a declared schema; ``header`` skips each first line."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(pattern)
    )


def write_text(lines: DataFrame, folder: str) -> None:
    """One text shard per partition below ``folder``."""
    lines.write.mode("overwrite").text(folder)


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON-lines shard per partition below ``folder``."""
    df.write.mode("overwrite").json(folder)


def file_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, start, end) for each file with any line in ``folder``.

    Lines are counted from all splits of a file at once and no text is kept, so a
    very large file is as parallel as many small ones.  Files of one name in different
    partition folders have ranges of their own.
    """
    lines = spark.read.text(folder)
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    return lines.groupBy(path.alias("path"), name.alias("name")).agg(
        F.lit(0).cast("bigint").alias("start"), F.count("*").alias("end")
    )


def text_ranges(table: DataFrame, name: str, text: str) -> DataFrame:
    """The same for a table that holds one text per row."""
    return table.select(
        F.col(name).alias("name"),
        F.lit(0).cast("bigint").alias("start"),
        line_total(F.col(text)).alias("end"),
    )


def positions(ranges: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per line: the range's columns and positions from start to end - 1.

    Long ranges are cut into pieces, and the pieces spread over the cluster, before
    they become rows.
    """
    of_file = [c for c in ranges.columns if c not in ("start", "end")]
    last = F.col("end") - 1
    whole = ranges.where(F.col("end") > F.col("start"))
    starts = F.sequence("start", last, F.lit(piece).cast("bigint"))
    pieces = whole.select(*of_file, F.explode(starts).alias("from"), last.alias("last"))
    pieces = pieces.repartition(*of_file, "from")
    upto = F.least(F.col("last"), F.col("from") + (piece - 1))
    return pieces.select(*of_file, F.explode(F.sequence("from", upto)).alias("position"))


def list_file_lines(spark: SparkSession, folder: str) -> DataFrame:
    return positions(file_ranges(spark, folder))


def position_lines(placed: DataFrame) -> DataFrame:
    """``file: name, position: i`` strings."""
    return placed.select(
        F.format_string("file: %s, position: %d", "name", "position").alias("value")
    )


def watch_directory(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the lines of files appearing in ``folder``, each file once.

    Subfolders are not entered.  ``ts`` is the file's modification time; the stream's
    checkpoint remembers which files were seen.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("ts"),
        "value",
    )


def batch_positions(lines: DataFrame) -> DataFrame:
    """Positions of the lines of one micro-batch of ``watch_directory``.

    A file always arrives whole in one micro-batch, so its range can be counted there.
    """
    ranges = lines.groupBy("path", "name").agg(
        F.lit(0).cast("bigint").alias("start"), F.count("*").alias("end")
    )
    return positions(ranges)
