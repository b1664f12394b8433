"""Dates and timestamps as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def rfc3339(ts: Column) -> Column:
    """UTC with a trailing Z; six fraction digits, only where there is a fraction."""
    fraction = F.date_format(ts, ".SSSSSS")
    shown = F.when(fraction == ".000000", "").otherwise(fraction)
    return F.concat(iso_seconds(ts), shown, F.lit("Z"))


def sql_seconds(text: Column) -> Column:
    """ISO date-time string cut to ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.to_timestamp(text), "yyyy-MM-dd HH:mm:ss")


def dashed_date(text: Column) -> Column:
    """``dd-MM-yyyy`` with optional blanks around it."""
    return F.to_date(F.trim(text), "dd-MM-yyyy")
