"""Counts over staff attendance rows (id, name, dept_no, dept, date)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attendance_by_name(staff: DataFrame) -> DataFrame:
    """The shared step of the department counts; use it with ``DataFrame.transform``."""
    return staff.groupBy("name").agg(F.count("*").alias("n"))


def sum_per_key(staff: DataFrame, dept: str = "Accounts") -> DataFrame:
    """Attendance count per name within one department."""
    return staff.where(F.col("dept") == dept).transform(attendance_by_name)


def group_then_count(staff: DataFrame, dept: str = "Accounts") -> DataFrame:
    """Grouping ones and summing each group, as a fold: no group is ever built."""
    ones = staff.where(F.col("dept") == dept).select("name", F.lit(1).alias("one"))
    return ones.groupBy("name").agg(F.sum("one").alias("n"))


def sum_struct_key(staff: DataFrame) -> DataFrame:
    """Sum of department numbers with the (id, name) struct as the key."""
    keyed = staff.select(
        F.struct("id", "name").alias("employee"), F.col("dept_no").cast("bigint")
    )
    return keyed.groupBy("employee").agg(F.sum("dept_no").alias("total"))


def flatten_union(staff: DataFrame, first: str = "Accounts", second: str = "HR") -> DataFrame:
    """Both departments' counts in one table; a name counted in both has two rows."""
    kept = staff.where(F.col("dept").isin(first, second))
    counts = kept.groupBy("dept", "name").agg(F.count("*").alias("n"))
    return counts.select("name", "n")


def union_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two keyed counts, duplicates kept."""
    return left.unionByName(right)
