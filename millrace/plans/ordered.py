"""Prefix computations over an order, without one big ordered partition.

A plain ``Window.orderBy`` puts the whole table into one task, and
``Window.partitionBy(key)`` puts a hot key into one.  Here the order is cut into
chunks of similar row counts wherever the rows lie: the whole table's order where
there are no keys, and otherwise the order within each key that is too large for one
task, so that a key with a third of the table spans a third of the chunks.

1. A sample of ``keys + order`` gives the cut points.  It takes a fixed share of the
   rows, so one pass tells both how many chunks the rows need and where to cut: a chunk
   has about ``ROWS_PER_CHUNK`` rows, however many rows there are and whatever the
   session's settings.
2. Each row finds its chunk by binary search among the cut points, unrolled into plain
   generated code.  The chunk is a pure function of the row: recomputed tasks agree.
3. Windows run within (chunk, keys).
4. What a chunk inherits from earlier chunks is computed on a table with at most two
   rows per chunk and joined back.

The driver sees at most ``DRIVER_ROWS`` rows of a sample, enough for the cut points of
about a billion rows.  A larger sample is a table, of which again a sample gives ``TOP_CUTS``
coarse cut points; the others are found between them, by task, and are a table as well.  A
row then finds its place among the coarse ones, and its chunk among those of that place.

The columns of ``keys + order`` must be integers or strings, and unique together.  Nulls
come first, as in a window's order; rows that repeat a value of the order share a chunk,
and are drawn into the sample only once.  A null key is never cut.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.shared import shared_folder
from millrace.plans.sizing import broadcast_if_small

CHUNK = "_chunk"
SAMPLE_PER_CHUNK = 32
ROWS_PER_CHUNK = 1_000_000
LARGEST_CHUNK = 4
TOP_CUTS = 1024
DRIVER_ROWS = TOP_CUTS * SAMPLE_PER_CHUNK
TOP, FIRST, LENGTH = "_top", "_cut_first", "_cut_length"


@dataclass(frozen=True)
class Chunked:
    """Rows with their chunk, and what is needed to carry values across chunks."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: list[tuple]
    fine: Fine | None = None

    def with_rows(self, rows: DataFrame) -> Chunked:
        """The same chunks over derived rows (one output row per input row)."""
        return replace(self, rows=rows)


@dataclass(frozen=True)
class Fine:
    """Cut points as a table: those of each place between the coarse ones, in order.

    The chunks of a place are numbered from ``place * width`` on; ``total`` are the cut points.
    """

    table: DataFrame
    width: int
    total: int


@dataclass(frozen=True)
class Fold:
    """An associative fold: how to aggregate, and how to combine two results."""

    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    value: Column


def fold_sum(value: Column) -> Fold:
    return Fold(F.sum, lambda a, b: a + b, value)


def fold_count() -> Fold:
    return Fold(F.sum, lambda a, b: a + b, F.lit(1).cast("bigint"))


def fold_max(value: Column) -> Fold:
    return Fold(F.max, F.greatest, value)


def fold_min(value: Column) -> Fold:
    return Fold(F.min, F.least, value)


def _whole(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _drawn(keys: DataFrame, wanted: int, of: int, seed: int = 0) -> DataFrame:
    """``wanted`` out of ``of`` rows without nulls, each value once.

    Rows are sampled by their hash, so that the same table gives the same sample however
    it is partitioned.
    """
    threshold = (wanted << 63) // of
    hashed = F.xxhash64(*([F.lit(seed)] if seed else []), *keys.columns)
    drawn = F.shiftrightunsigned(hashed, 1) < threshold
    return keys.where(drawn & _whole(keys.columns)).distinct()


def _to_driver(sample: DataFrame, limit: int) -> list[tuple]:
    """At most ``limit`` rows of a sample, in order.

    A limit at the top of a plan would be met by one job after another, over ever more
    partitions; below a column that can't be moved it is a step of one job.
    """
    some = sample.limit(limit).withColumn("_row", F.monotonically_increasing_id())
    return sorted(tuple(row)[:-1] for row in some.collect())


def _quantiles(ranked: list[tuple], chunks: int) -> list[tuple]:
    return sorted({ranked[i * len(ranked) // chunks] for i in range(1, chunks)} if ranked else ())


Draw = Callable[[int, int], DataFrame]


def _cut_points(
    source: DataFrame,
    columns: Sequence[str],
    chunks: int | None,
    rows_per_chunk: int,
    draw: Draw | None,
    total: Column,
) -> tuple[list[tuple], Fine | None]:
    """Quantiles of a uniform sample; none if one chunk is enough.

    Without a given number of chunks it follows from the size of the sample; a given one is
    raised where the chunks would have more than ``LARGEST_CHUNK`` times ``rows_per_chunk`` rows.
    """
    draw = draw or (lambda wanted, of: _drawn(source.select(*columns), wanted, of))
    if chunks is None:
        sample = draw(min(SAMPLE_PER_CHUNK, rows_per_chunk), rows_per_chunk)
    else:
        rows, wanted = source.agg(total).head()[0] or 0, chunks * SAMPLE_PER_CHUNK
        if rows <= wanted:
            return [], None
        chunks = max(chunks, -(-rows // (LARGEST_CHUNK * rows_per_chunk)))
        sample = draw(chunks * SAMPLE_PER_CHUNK, rows)
    ranked = _to_driver(sample, DRIVER_ROWS + 1)
    if len(ranked) > DRIVER_ROWS:
        return _two_levels(sample, chunks)
    return _quantiles(ranked, chunks or -(-len(ranked) // SAMPLE_PER_CHUNK)), None


def _two_levels(sample: DataFrame, chunks: int | None) -> tuple[list[tuple], Fine]:
    """Coarse cut points for the driver, and a table of all others."""
    spark, schema = sample.sparkSession, sample.schema
    path = shared_folder(spark, "sample")
    sample.write.parquet(path)
    sample = spark.read.schema(schema).parquet(path)
    rows = sample.count()
    ranked = _to_driver(_drawn(sample, DRIVER_ROWS // 2, rows, seed=1), DRIVER_ROWS)
    coarse = _quantiles(ranked, TOP_CUTS)
    placed = _place(sample, sample.columns, coarse).withColumnRenamed(CHUNK, TOP)
    by_order = Window.partitionBy(TOP).orderBy(*sample.columns)
    every = max(rows // chunks, 1) if chunks else SAMPLE_PER_CHUNK
    numbered = placed.withColumn("_nth", F.row_number().over(by_order))
    cut = F.struct(*sample.columns)
    table = (
        numbered.where(F.col("_nth") % every == 0)
        .groupBy(TOP)
        .agg(F.array_sort(F.collect_list(cut)).alias("_cuts"))
    )
    path = shared_folder(spark, "cuts")
    table.write.parquet(path)
    table = spark.read.schema(table.schema).parquet(path)
    longest, total = table.agg(F.max(F.size("_cuts")), F.sum(F.size("_cuts"))).head()
    return coarse, Fine(table, (longest or 0) + 1, total or 0)


def _constant_table(like: DataFrame, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A small table out of one literal, whose parsing the optimizer folds away."""
    constant = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schema))
    return like.sparkSession.range(1).select(F.inline(constant))


def _constant_arrays(
    schema: T.StructType, columns: Sequence[str], cuts: list[tuple]
) -> list[Column]:
    """The cut points' values, one constant array per column."""
    return [
        F.from_json(
            F.lit(json.dumps([cut[i] for cut in cuts])),
            T.ArrayType(schema[column].dataType),
        )
        for i, column in enumerate(columns)
    ]


def _not_above(columns: Sequence[str], cuts: Sequence[Column], at: Column) -> Column:
    """Whether cut number ``at`` is at most the row; null past the last cut."""
    *leading, last = zip(columns, cuts)
    result = F.get(last[1], at) <= F.col(last[0])
    for column, cut in reversed(leading):
        value = F.get(cut, at)
        result = (value < F.col(column)) | ((value == F.col(column)) & result)
    return result


def _search(
    rows: DataFrame,
    columns: Sequence[str],
    cuts: list[tuple],
    first: Column,
    length: Column,
    longest: int,
) -> DataFrame:
    """Add how many of the ``length`` cuts from number ``first`` on are at most the row.

    One projection per halving.  Each uses the one before more than once, which keeps
    the optimizer from folding them into one expression of exponential size.
    """
    return _halved(rows, columns, _constant_arrays(rows.schema, columns, cuts), first, length, longest)


def _halved(
    rows: DataFrame,
    columns: Sequence[str],
    arrays: Sequence[Column],
    first: Column,
    length: Column,
    longest: int,
) -> DataFrame:
    rows = rows.withColumn(CHUNK, F.lit(0))
    for step in reversed([2**i for i in range(longest.bit_length())]):
        found = F.col(CHUNK)
        reached = (found + step <= length) & _not_above(
            columns, arrays, first + found + (step - 1)
        )
        rows = rows.withColumn(CHUNK, F.when(reached, found + step).otherwise(found))
    return rows


def _place(rows: DataFrame, order: Sequence[str], cuts: list[tuple]) -> DataFrame:
    """Chunks of the whole table's order."""
    return _search(rows, order, cuts, F.lit(0), F.lit(len(cuts)), len(cuts))


def _place_in_keys(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: list[tuple]
) -> DataFrame:
    """Chunks of the order within each key that has cut points; chunk 0 elsewhere.

    The cut points are sorted, so those of a key lie side by side; a lookup says where.
    It has at most one row per cut point.  A key that is not in it is small, and its
    rows pass with nothing but the missed lookup.
    """
    of_key = [cut[: len(keys)] for cut in cuts]
    sizes = Counter(of_key)
    starts = accumulate(sizes.values(), initial=0)
    runs = dict(zip(sizes, zip(starts, sizes.values())))
    schema = T.StructType(
        [rows.schema[key] for key in keys]
        + [T.StructField(FIRST, T.IntegerType()), T.StructField(LENGTH, T.IntegerType())]
    )
    table = [dict(zip(schema.fieldNames(), key + run)) for key, run in runs.items()]
    joined = rows.join(
        F.broadcast(_constant_table(rows, table, schema)), list(keys), "left"
    )
    in_key = [cut[len(keys) :] for cut in cuts]
    longest = max(length for _, length in runs.values())
    found = _search(joined, order, in_key, F.col(FIRST), F.col(LENGTH), longest)
    return found.drop(FIRST, LENGTH)


def _place_by_table(
    rows: DataFrame, columns: Sequence[str], coarse: list[tuple], fine: Fine
) -> DataFrame:
    """Chunks among the cut points of a row's place between the coarse ones.

    They are one order over keys and the rest: a key without a cut point in it lies in one
    chunk.
    """
    placed = _place(rows, columns, coarse).withColumnRenamed(CHUNK, TOP)
    joined = placed.join(broadcast_if_small(fine.table), TOP, "left")
    arrays = [F.col("_cuts").getField(column) for column in columns]
    length = F.coalesce(F.size("_cuts"), F.lit(0))
    found = _halved(joined, columns, arrays, F.lit(0), length, fine.width - 1)
    number = F.col(TOP).cast("bigint") * fine.width + F.col(CHUNK)
    return found.withColumn(CHUNK, number).drop(TOP, "_cuts")


def chunked(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    chunks: int | None = None,
    sample_from: DataFrame | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    draw: Draw | None = None,
    total: Column | None = None,
) -> Chunked:
    """Assign chunks: about one per ``rows_per_chunk`` rows, or ``chunks``, raised for large tables.

    ``sample_from`` lets a cheaper table with the same values of ``keys + order`` stand in
    for ``df``.  ``draw`` does so where the values have to be made first: it returns
    ``wanted`` out of ``of`` of them, where ``total``, over ``sample_from``, is how many there
    are.
    """
    columns = [*keys, *order]
    source = df if sample_from is None else sample_from
    count = F.count("*") if total is None else total
    cuts, fine = _cut_points(source, columns, chunks, rows_per_chunk, draw, count)
    if fine is not None:
        rows = _place_by_table(df, columns, cuts, fine)
    elif not cuts:
        rows = df.withColumn(CHUNK, F.lit(0))
    elif keys:
        rows = _place_in_keys(df, keys, order, cuts)
    else:
        rows = _place(df, order, cuts)
    return Chunked(rows, tuple(keys), tuple(order), cuts, fine)


def _crossing(parts: Chunked) -> DataFrame:
    """The keys that have a cut point in them; at most as many as cut points."""
    rows, positions = parts.rows, range(len(parts.keys))
    keys = sorted({tuple(cut[i] for i in positions) for cut in parts.cuts})
    key_type = T.StructType([rows.schema[k] for k in parts.keys])
    coarse = _constant_table(rows, [dict(zip(parts.keys, key)) for key in keys], key_type)
    if parts.fine is None:
        return F.broadcast(coarse)
    cut = F.explode("_cuts").alias("_cut")
    fine = parts.fine.table.select(cut).select(*[F.col(f"_cut.{k}") for k in parts.keys])
    return broadcast_if_small(coarse.unionByName(fine).distinct())


def _apart(parts: Chunked) -> DataFrame:
    """The rows, laid out by chunk where the session's partitions would hold many chunks each."""
    chunks = 1 + len(parts.cuts) + (parts.fine.total if parts.fine else 0)
    spark = parts.rows.sparkSession
    if chunks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return parts.rows
    return parts.rows.repartition(chunks, CHUNK, *parts.keys)


def _folded_before(
    table: DataFrame, folds: dict[str, Fold], keys: Sequence[str], order: str
) -> dict[str, Column]:
    """For each fold, what comes before a row of the table within the keys."""
    before = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return {name: f.aggregate(F.col(name)).over(before) for name, f in folds.items()}


def _carried(parts: Chunked, folds: dict[str, Fold]) -> DataFrame:
    """Per chunk (and crossing key), the fold of everything in earlier chunks.

    Only the key of a cut point has more than one chunk, so other keys are dropped
    before aggregating and the result has at most two rows per cut point.  Where the cut
    points are a table, the chunks of each place are folded by themselves, and the places,
    of which there are at most ``TOP_CUTS``, after them.
    """
    rows, keys = parts.rows, list(parts.keys)
    if keys:
        rows = rows.join(_crossing(parts), keys, "left_semi")
    per_chunk = rows.groupBy(CHUNK, *keys).agg(
        *[f.aggregate(f.value).alias(name) for name, f in folds.items()]
    )
    if parts.fine is None:
        before = _folded_before(per_chunk, folds, keys, CHUNK)
        return per_chunk.select(CHUNK, *keys, *[c.alias(n) for n, c in before.items()])
    per_chunk = per_chunk.withColumn(TOP, F.floor(F.col(CHUNK) / parts.fine.width))
    totals = per_chunk.groupBy(TOP, *[F.col(k).alias(f"_of_{k}") for k in keys]).agg(
        *[f.aggregate(F.col(name)).alias(name) for name, f in folds.items()]
    )
    of_keys = [f"_of_{k}" for k in keys]
    earlier = _folded_before(totals, folds, of_keys, TOP)
    places = totals.select(
        F.col(TOP).alias("_place"), *of_keys, *[c.alias(f"_earlier_{n}") for n, c in earlier.items()]
    )
    within = _folded_before(per_chunk, folds, [TOP, *keys], CHUNK)
    chunks = per_chunk.select(CHUNK, TOP, *keys, *[c.alias(n) for n, c in within.items()])
    same = [F.col(TOP) == F.col("_place"), *[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]]
    joined = chunks.join(places, same)
    values = []
    for name, fold in folds.items():
        first, value = F.col(f"_earlier_{name}"), F.col(name)
        values.append(F.coalesce(fold.combine(first, value), value, first).alias(name))
    return joined.select(CHUNK, *keys, *values)


def _join_carried(
    windowed: DataFrame, parts: Chunked, folds: dict[str, Fold]
) -> tuple[DataFrame, list[str]]:
    """Add each chunk's inherited values to rows whose windows are already computed.

    The join comes after the windows so that their shuffle does not wait for it.
    """
    if not parts.cuts:
        return windowed, []
    names = [f"_carried_{name}" for name in folds]
    carried = _carried(parts, dict(zip(names, folds.values())))
    # Without a hint the table's shuffle meets rows that lie by chunk and keys already.
    table = F.broadcast(carried) if parts.fine is None else carried
    return windowed.join(table, [CHUNK, *parts.keys], "left"), names


def running(
    parts: Chunked,
    folds: dict[str, Fold],
    include_current: bool = True,
    start: dict[str, Column] | None = None,
) -> DataFrame:
    """Add the prefix fold of each row under each given name.

    Without ``include_current`` the first row of a key gets null.  ``start`` has values, null
    for none, that came before all rows and are folded in first.
    """
    last = Window.currentRow if include_current else -1
    prefix = (
        Window.partitionBy(CHUNK, *parts.keys)
        .orderBy(*parts.order)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    local = {f"_local_{n}": f.aggregate(f.value).over(prefix) for n, f in folds.items()}
    rows, carried = _join_carried(_apart(parts).withColumns(local), parts, folds)
    results = {}
    for i, (name, fold) in enumerate(folds.items()):
        value = F.col(f"_local_{name}")
        if carried:
            earlier = F.col(carried[i])
            value = F.coalesce(fold.combine(earlier, value), value, earlier)
        if start is not None:
            first = start[name]
            value = F.coalesce(fold.combine(first, value), value, first)
        results[name] = value
    return rows.withColumns(results).drop(*local, *carried)


def previous(parts: Chunked, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + column`` holding the value from the key's previous row."""
    within = Window.partitionBy(CHUNK, *parts.keys).orderBy(*parts.order)
    marker = "_preceded"
    lags = {marker: F.lag(F.lit(True)).over(within)}
    lags |= {f"{prefix}{c}": F.lag(c).over(within) for c in columns}
    windowed = _apart(parts).withColumns(lags)
    latest = fold_max(F.struct(*parts.order, *[F.col(c).alias(f"_{c}") for c in columns]))
    rows, carried = _join_carried(windowed, parts, {"previous": latest})
    if carried:
        first = F.col(marker).isNull()
        rows = rows.withColumns(
            {
                f"{prefix}{c}": F.when(first, F.col(f"{carried[0]}._{c}")).otherwise(
                    F.col(f"{prefix}{c}")
                )
                for c in columns
            }
        )
    return rows.drop(marker, *carried)
