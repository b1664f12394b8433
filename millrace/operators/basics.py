"""Projections, filters and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import sql_seconds


def filter_select_optin(log: DataFrame) -> DataFrame:
    """Web-log rows of users who opted in, without the request columns."""
    return log.where(F.col("opted_into_marketing")).select(
        "ip", "id", "lat", "lng", "age_bracket"
    )


def sql_filter_eq(items: DataFrame, name: str = "jack") -> DataFrame:
    """Equality filter written in SQL, with the value bound as a parameter."""
    return items.sparkSession.sql(
        "SELECT * FROM {items} WHERE name = :name", args={"name": name}, items=items
    )


def add_constant(df: DataFrame, column: str = "value", amount: float = 1000) -> DataFrame:
    return df.withColumn(column, F.col(column) + F.lit(amount))


def squares_cubes(df: DataFrame, column: str) -> DataFrame:
    """Square and cube of an integer column, in BIGINT."""
    x = F.col(column).cast("bigint")
    return df.withColumns({"square": x * x, "cube": x * x * x})


def filter_evens(df: DataFrame, column: str) -> DataFrame:
    """Even values only.  Text that is not an integer fails the query."""
    value = F.expr(f"CAST(`{column}` AS BIGINT)")
    return df.where(value % 2 == 0)


def split_csv_row(lines: DataFrame, column: str = "value") -> DataFrame:
    """One list of fields per line."""
    return lines.withColumn("fields", F.split(column, ",", -1))


def split_csv_flat(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per field."""
    return lines.select(F.explode(F.split(column, ",", -1)).alias("field"))


def excluding(df: DataFrame, column: str, unwanted: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose ``column`` is not in a list or in a one-column table, null-safe.

    A null is excluded by a null among the unwanted, and by nothing else.
    """
    if isinstance(unwanted, DataFrame):
        other = unwanted.toDF("_unwanted").distinct()
        return df.join(other, F.col(column).eqNullSafe(F.col("_unwanted")), "left_anti")
    listed = [value for value in unwanted if value is not None]
    found = F.coalesce(F.col(column).isin(listed), F.lit(False))
    if len(listed) < len(unwanted):
        found = found | F.col(column).isNull()
    return df.where(~found)


def filter_by_length_side(
    staff: DataFrame,
    unwanted_ids: Sequence[str] | DataFrame,
    shortest: int,
    longest: int | None = None,
) -> DataFrame:
    """Names within inclusive length bounds whose id is not in the side list."""
    length = F.length("name")
    kept = length >= shortest
    if longest is not None:
        kept = kept & (length <= longest)
    return excluding(staff.where(kept), "id", unwanted_ids)


def route_names(staff: DataFrame, cutoff: int = 4) -> DataFrame:
    """Tag each name with the output it goes to."""
    return staff.withColumn(
        "route",
        F.when(F.length("name") <= cutoff, "short_names").otherwise("long_names"),
    )


def routed(tagged: DataFrame) -> dict[str, DataFrame]:
    """The three outputs of ``route_names``.

    Every length is either at most or above the cutoff, so nothing can reach the
    main output; it exists and is empty.
    """

    def output(name: str) -> DataFrame:
        return tagged.where(F.col("route") == name).select("name")

    return {name: output(name) for name in ("short_names", "long_names", "main")}


def normalise_datetime(log: DataFrame, column: str = "event_datetime") -> DataFrame:
    """Cut an ISO date-time string to whole seconds in SQL notation."""
    return log.withColumn(column, sql_seconds(F.col(column)))


def as_json(columns: Sequence[str]) -> Column:
    """JSON object of the named columns, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
