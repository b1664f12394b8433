"""Pace and status rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status limits.
UNDERPERFORMING_BELOW = 0.9
PACING_BELOW = 1.1


def ratio_or(total: Column, duration: Column, otherwise: Column) -> Column:
    """``total / duration`` in DOUBLE, or ``otherwise`` where the duration is zero."""
    safe = F.when(duration == 0, F.lit(None)).otherwise(duration)
    return F.coalesce(total.cast("double") / safe, otherwise)


def speed(distance: Column, micros: Column) -> Column:
    """Distance per second from a duration in microseconds; 0 without duration."""
    return ratio_or(distance.cast("double") * 1e6, micros, F.lit(0.0))


def mean_pace(distance: Column, micros: Column) -> Column:
    """Distance per second; NaN without duration."""
    return ratio_or(distance.cast("double") * 1e6, micros, F.lit(float("nan")))


def status_of(relative: Column) -> Column:
    return (
        F.when(relative < UNDERPERFORMING_BELOW, "underperforming")
        .when(relative < PACING_BELOW, "pacing")
        .otherwise("outperforming")
    )


def pace_status(short: Column, long: Column) -> Column:
    """Status of a short pace against a long one; null if either is null or zero."""
    usable = (short != 0) & (long != 0)
    return F.when(usable, status_of(F.try_divide(short, long)))
