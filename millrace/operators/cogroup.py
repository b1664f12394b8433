"""Grouping two keyed tables side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import chunked, fold_count, running


def _values(tag: int, name: str) -> Column:
    chosen = F.when(F.col("_side") == tag, F.col("_value"))
    return F.array_sort(F.collect_list(chosen)).alias(name)


def cogroup_two(left: DataFrame, right: DataFrame, key: str, value: str = "value") -> DataFrame:
    """Every key of either side in one row, with the sorted list of each side's values.

    A key's values must fit a row; ``cogroup_parts`` has no such bound.
    """
    sides = [
        side.select(F.col(key), F.lit(tag).alias("_side"), F.col(value).alias("_value"))
        for tag, side in enumerate([left, right])
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(key)
        .agg(_values(0, "left_values"), _values(1, "right_values"))
    )


def cogroup_parts(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_order: Sequence[str],
    right_order: Sequence[str],
    max_list: int,
    value: str = "value",
    chunks: int | None = None,
) -> DataFrame:
    """The same in parts of at most ``max_list`` values per side.

    The lists of a key with more values continue in further parts, so no task ever holds
    a whole hot group and no value is lost.  The order columns of a side (integers or
    strings) must be unique within a key; they decide the part a value falls in.
    """
    sides = []
    for tag, (side, order) in enumerate([(left, left_order), (right, right_order)]):
        ranks = {f"_o{i}": F.col(c).cast("string") for i, c in enumerate(order)}
        columns = [F.col(key), F.lit(tag).alias("_side"), F.col(value).alias("_value")]
        sides.append(side.select(*columns, *[c.alias(n) for n, c in ranks.items()]))
    width = max(len(left_order), len(right_order))
    order = [f"_o{i}" for i in range(width)]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    both = both.fillna("", subset=order)
    parts = chunked(both, order, keys=[key, "_side"], chunks=chunks)
    numbered = running(parts, {"_n": fold_count()})
    part = F.floor((F.col("_n") - 1) / max_list).cast("bigint")
    return numbered.groupBy(key, part.alias("part")).agg(
        _values(0, "left_values"), _values(1, "right_values")
    )
