"""Balanced contiguous shards from byte-size prefix sums.

Rows get an order, their sizes a global prefix sum, and the sum is cut at equal targets.
The order is cut into cells of similar row counts; only the totals of the cells are
summed up globally, each row is placed inside its own cell.  The order follows a hash of
the group, so equal groups are neighbours; a group of more rows than a cell holds is
spread over several cells by the row's id.  A group of at most ``WHOLE`` of a shard's
bytes is never divided by a cut.

Defined results: a null text has no bytes and checksum 0; null ids and repeated rows are
rows like any other; a single row larger than a shard makes that shard larger; an empty
table gives no rows.  Columns of the names of added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

CELL_ROWS = 50_000
WHOLE = 0.05


def _scaled(hashed: Column, parts: Column) -> Column:
    """The part, of ``parts`` equal ones, of the range of unsigned hashes."""
    return F.shiftright(F.shiftrightunsigned(hashed, 33) * parts, 31)


def byte_shards(
    rows: DataFrame,
    shards: int,
    size: str = "size",
    group: str = "group",
    row_id: str = "doc_id",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The rows with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0).

    ``rows`` is read several times: give a written table.  Every column is shuffled, so
    give narrow rows.
    """
    own = rows.drop(*[c for c in ("shard", "slot") if c in rows.columns])
    whole = Window.partitionBy()
    hashed = own.withColumns(
        {"__h": F.xxhash64(group), "__d": F.xxhash64(F.col(row_id), F.col(size))}
    )
    hot = written(
        hashed.groupBy(F.col("__h").alias("__hot"))
        .agg(F.ceil(F.count(F.lit(1)) / cell_rows).alias("__parts"))
        .filter(F.col("__parts") > 1),
        "shard-hot",
    )
    bands = F.lit(max(1, -(-own.count() // cell_rows))).cast("bigint")
    celled = hashed.join(hot, F.col("__h") == F.col("__hot"), "left").withColumns(
        {
            "__band": _scaled(F.col("__h"), bands),
            "__part": F.coalesce(_scaled(F.col("__d"), F.col("__parts")), F.lit(0)),
        }
    )
    cell = ["__band", "__hot", "__part"]
    in_order = Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = written(
        celled.groupBy(*cell)
        .agg(F.sum(size).alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
        .select(
            *[F.col(c).alias(f"{c}_of") for c in cell],
            F.coalesce(F.sum("__bytes").over(in_order), F.lit(0)).alias("__bytes_before"),
            F.coalesce(F.sum("__rows").over(in_order), F.lit(0)).alias("__rows_before"),
            F.sum("__bytes").over(whole).alias("__total"),
        ),
        "shard-cells",
    )
    inside = Window.partitionBy(*cell).orderBy("__h", "__d", row_id)
    rows_so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    of_group = Window.partitionBy(*cell, "__h")
    same_cell = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in cell]
    end = F.least(
        F.lit(shards - 1),
        F.floor(F.col("__middle") * shards / F.greatest(F.col("__total"), F.lit(1))),
    )
    undivided = F.col("__hot").isNull() & (
        F.col("__group_bytes") <= WHOLE * F.col("__total") / shards
    )
    placed = (
        celled.join(cells, same_cell[0] & same_cell[1] & same_cell[2])
        .withColumns(
            {
                "__before": F.col("__bytes_before")
                + F.coalesce(F.sum(size).over(rows_so_far), F.lit(0)),
                "__index": F.col("__rows_before") + F.row_number().over(inside) - 1,
                "__group_bytes": F.sum(size).over(of_group),
            }
        )
        .withColumn("__group_before", F.min("__before").over(of_group))
        .withColumn(
            "__middle",
            F.when(undivided, F.col("__group_before") + F.col("__group_bytes") / 2).otherwise(
                F.col("__before") + F.col(size) / 2
            ),
        )
        .withColumn("shard", end.cast("int"))
        .select(*own.columns, "shard", "__index")
    )
    placed = written(placed, "shard-rows")
    first = placed.groupBy(F.col("shard").alias("__shard")).agg(F.min("__index").alias("__first"))
    return placed.join(written(first, "shard-first"), F.col("shard") == F.col("__shard")).select(
        *own.columns, "shard", (F.col("__index") - F.col("__first")).alias("slot")
    )


def sized(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the group: a digest of the text."""
    body = F.col(text).cast("binary")
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("group"),
    )
