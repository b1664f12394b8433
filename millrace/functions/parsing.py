"""Typed rows from raw messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# lat and lng may be numbers, null or empty strings, so they are read as text first.
EVENT_LOG_JSON = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("lat", T.StringType()),
        T.StructField("lng", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("age_bracket", T.StringType()),
        T.StructField("opted_into_marketing", T.BooleanType()),
        T.StructField("http_request", T.StringType()),
        T.StructField("http_response", T.IntegerType()),
        T.StructField("file_size_bytes", T.IntegerType()),
        T.StructField("event_datetime", T.StringType()),
        T.StructField("event_ts", T.LongType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)
EVENT_LOG_FIELDS = [f.name for f in EVENT_LOG_JSON if f.name != "_corrupt"]


def _missing(coordinate: Column) -> Column:
    """Null, empty, and zero all count as missing."""
    number = coordinate.try_cast("double")
    return coordinate.isNull() | (coordinate == "") | F.coalesce(number == 0, F.lit(False))


def parse_event_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to web-log rows; both coordinates become -1 if either is missing.

    A line that is not valid JSON stays, with its text in ``_corrupt``.
    """
    options = {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    rows = lines.select(F.from_json(F.col(column), EVENT_LOG_JSON, options).alias("r"))
    no_place = _missing(F.col("r.lat")) | _missing(F.col("r.lng"))

    def field(name: str) -> Column:
        value = F.col(f"r.{name}")
        if name in ("lat", "lng"):
            value = F.when(no_place, F.lit(-1.0)).otherwise(value.try_cast("double"))
        return value.alias(name)

    return rows.select(*map(field, EVENT_LOG_FIELDS), F.col("r._corrupt").alias("_corrupt"))


def with_event_time(log: DataFrame) -> DataFrame:
    """Event time of a web-log row from its ISO date-time."""
    return log.withColumn("ts", F.to_timestamp("event_datetime"))


def parse_positions(lines: DataFrame, column: str = "value") -> DataFrame:
    """``user <tab> spot <tab> epoch seconds`` to typed rows with an event time.

    A line with a field missing, or one that is no number, stays, with what can be read
    and its text in ``_corrupt``.
    """
    part = F.split(F.regexp_replace(F.col(column), "\n", ""), "\t")
    seconds = F.get(part, 2).try_cast("double")
    rows = lines.select(
        F.get(part, 0).alias("user"),
        F.get(part, 1).try_cast("int").alias("spot"),
        # Seconds that no timestamp can hold are as good as none.
        F.timestamp_seconds(F.when(F.abs(seconds) < 1e11, seconds)).alias("ts"),
        F.col(column).alias("_line"),
    )
    whole = F.col("spot").isNotNull() & F.col("ts").isNotNull()
    return rows.select("user", "spot", "ts", F.when(~whole, F.col("_line")).alias("_corrupt"))
