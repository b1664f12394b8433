"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target of words.  Complete epochs take every document of the source;
the rest of the target goes to the documents with the smallest exponential keys
``-ln(u) / weight``, summed up in the order of the keys.  Whole documents rarely hit a
budget, so one closing document may follow: the one next in the order, within its cell of
keys, that comes nearest.

The decision about a row depends only on the row and on one cut per source, so texts are
never sorted or shuffled.  The cut is found by counting cells of keys, whose number per
source follows its rows; only the one cell that holds the cut is put in order.  A source
with a third of all rows is thus no different from any other.

Defined results: a null source is a source of its own and comes last; a null id has the
key of an empty one; a null text has no words; rows of one id are taken or left together;
sources without words have target 0; an empty table gives no rows.  Added columns replace
those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
CELL_ROWS = 4096


def quality_weight(text: Column) -> Column:
    """0.5 to 1: the share of letters among the characters of words."""
    body = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(body, r"\P{L}+", ""))
    others = F.length(F.regexp_replace(body, f"{SPACE}+", ""))
    return F.lit(0.5) + F.lit(0.5) * letters / F.greatest(others, F.lit(1))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight, with u from the first 52 bits of the id's digest."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(2**52))) / weight


def targets(rows: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """Per source: rows, words, mean weight and target.

    Weights are dealt to the sources in their order.  A source is full at ``most`` times
    its words; the level that the others share is the largest quotient of what is left
    and the weights left, over the sources in the order in which they fill up.  The
    windows run over the sources alone, of which a mix names its weights.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("ratio", "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("nth"))
    left = F.lit(share) * F.sum("words").over(everything) - F.coalesce(
        F.sum("most").over(before), F.lit(0)
    )
    weights_left = F.sum("share").over(everything) - F.coalesce(
        F.sum("share").over(before), F.lit(0)
    )
    return (
        rows.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("size").alias("words"),
            F.avg("weight").alias("mean_weight"),
        )
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("nth", F.col("rank") % len(weights))
        .withColumn("nth", F.when(F.col("nth") == 0, len(weights)).otherwise(F.col("nth")))
        .withColumn("share", dealt)
        .withColumn("most", F.col("words") * F.lit(float(most)))
        .withColumn("ratio", F.col("most") / F.col("share"))
        .withColumn("level", left / weights_left)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("most", F.col("share") * F.col("level")))
        .select("source", "n", "words", "mean_weight", "target")
    )


def _cell() -> Column:
    """The keys' order in about n / CELL_ROWS cells, more or less alike in size."""
    spread = 1 - F.exp(-F.col("key") * F.col("mean_weight"))
    return F.floor(spread * F.ceil(F.col("n") / CELL_ROWS))


def cuts(rows: DataFrame) -> DataFrame:
    """Per source: epochs, the largest key taken, and the closing key.

    ``rows`` has source, size, weight and key.
    """
    goals = (
        written(targets(rows), "mix-targets")
        .withColumn(
            "epochs",
            F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0),
        )
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("words"))
    )
    same = goals["source"].eqNullSafe(rows["source"])
    placed = rows.join(goals.drop("words", "target", "epochs"), same).select(
        rows["source"], "size", "key", "budget", _cell().alias("cell")
    )
    running = Window.partitionBy("source").orderBy("cell")
    edges = (
        placed.groupBy("source", "cell", "budget")
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.sum("words").over(running))
        .filter(F.col("until") > F.col("budget"))
        .groupBy("source")
        .agg(
            F.min("cell").alias("edge"),
            F.min_by(F.col("until") - F.col("words"), "cell").alias("before"),
        )
    )
    edges = written(edges, "mix-edges")
    of_edge = placed.join(
        edges.withColumnRenamed("source", "edge_source"),
        F.col("edge_source").eqNullSafe(F.col("source")) & (F.col("cell") == F.col("edge")),
    )
    in_order = Window.partitionBy("source").orderBy("key")
    whole = Window.partitionBy("source")
    budget = F.col("budget") - F.col("before")
    taken = F.coalesce(F.max(F.when(F.col("until") <= budget, F.col("until"))).over(whole), F.lit(0))
    nearer = (F.col("until") > budget) & (F.col("words") < 2 * F.col("gap"))
    nearest = F.struct(F.abs(F.col("gap") - F.col("words")), F.col("key"))
    found = (
        of_edge.groupBy("source", "key", "budget", "before")
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.sum("words").over(in_order))
        .withColumn("gap", budget - taken)
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("until") <= budget, F.col("key"))).alias("last"),
            F.min_by(F.when(nearer, F.col("key")), F.when(nearer, nearest)).alias("closing"),
            F.min("key").alias("first"),
        )
    )
    # No key of the edge cell taken: everything below its first key still is.
    found = found.select(
        F.col("source").alias("cut_source"),
        F.coalesce("last", "first").alias("cut"),
        F.col("last").isNotNull().alias("with_cut"),
        "closing",
    )
    return goals.join(found, F.col("cut_source").eqNullSafe(F.col("source")), "left").select(
        F.col("source").alias("cut_source"),
        F.col("words").alias("source_size"),
        "target",
        "epochs",
        # Nothing exceeds the budget: every document is taken (sources of no words).
        F.col("cut").isNull().alias("all"),
        "cut",
        "with_cut",
        "closing",
    )


def mixed(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The documents with size, source_size, target, copies and taken."""
    weight = quality_weight(F.col(text))
    rows = written(
        documents.select(
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            weight.alias("weight"),
            exponential_key(F.col(doc_id), weight).alias("key"),
        ),
        "mix-rows",
    )
    found = written(cuts(rows), "mix-cuts")
    found = found.withColumnsRenamed({c: f"__{c}" for c in found.columns})
    key = exponential_key(F.col(doc_id), weight)
    budget = F.col("target") - F.col("__epochs") * F.col("source_size")
    selected = F.col("__all") | (budget > 0) & (
        (F.col("__key") < F.col("__cut"))
        | (F.col("__with_cut") & (F.col("__key") == F.col("__cut")))
        | F.coalesce(F.col("__key") == F.col("__closing"), F.lit(False))
    )
    added = ["size", "source_size", "target", "copies", "taken"]
    own = documents.drop(*[c for c in added if c in documents.columns])
    return (
        own.withColumns({"size": word_count(F.col(text)), "__key": key})
        .join(found, F.col(source).eqNullSafe(F.col("__cut_source")))
        .withColumnsRenamed({"__source_size": "source_size", "__target": "target"})
        .withColumn("copies", F.col("__epochs") + F.coalesce(selected, F.lit(False)).cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*own.columns, *added)
    )


ORACLE = r"""
    WITH measured AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''),
                                   '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
               CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE)
               * length(regexp_replace(coalesce(text, ''), '\P{L}+', '', 'g'))
               / greatest(length(regexp_replace(coalesce(text, ''),
                                                '[\x20\x09-\x0D]+', '', 'g')), 1) AS weight
        FROM documents
    ),
    keyed AS (
        SELECT *, -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT)
                       + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE)) / weight AS key,
               count(*) OVER (PARTITION BY source) AS n, avg(weight) OVER (PARTITION BY source) AS mw
        FROM measured
    ),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS words,
               [2, 3, 1][row_number() OVER (ORDER BY source NULLS LAST) % 3 + 1] AS share,
               row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM measured GROUP BY source
    ),
    levels AS (
        SELECT *, max(
            (CAST(1.5 AS DOUBLE) * allwords - used) / (allshare - usedshare)) OVER () AS level
        FROM (
            SELECT *, sum(words) OVER () AS allwords, sum(share) OVER () AS allshare,
                   coalesce(sum(2 * words) OVER f, 0) AS used,
                   coalesce(sum(share) OVER f, 0) AS usedshare
            FROM sources
            WINDOW f AS (ORDER BY CAST(2 * words AS DOUBLE) / share, rank
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
    ),
    goals AS (
        SELECT source, words, least(2.0 * words, share * level) AS target,
               CASE WHEN words > 0
                    THEN CAST(floor(least(2.0 * words, share * level) / words) AS BIGINT)
                    ELSE 0 END AS epochs
        FROM levels
    ),
    ordered AS (
        SELECT k.*, g.words AS source_size, g.target, g.epochs,
               g.target - g.epochs * g.words AS budget,
               floor((1 - exp(-key * mw)) * ceil(n / CAST(4096 AS DOUBLE))) AS cell,
               sum(size) OVER (PARTITION BY k.source ORDER BY key) AS until
        FROM keyed k JOIN goals g ON k.source IS NOT DISTINCT FROM g.source
    ),
    gaps AS (
        SELECT *, budget - coalesce(max(CASE WHEN until <= budget THEN until END)
                                    OVER (PARTITION BY source), 0) AS gap,
               min(CASE WHEN until > budget THEN cell END) OVER (PARTITION BY source) AS edge
        FROM ordered
    ),
    closed AS (
        SELECT *, until <= budget OR coalesce(
            key = first_value(CASE WHEN until > budget AND cell = edge AND size < 2 * gap
                                   THEN key END)
                  OVER (PARTITION BY source
                        ORDER BY CASE WHEN until > budget AND cell = edge AND size < 2 * gap
                                      THEN abs(gap - size) END NULLS LAST, key), false) AS chosen
        FROM gaps
    )
    SELECT doc_id, size, source_size, target,
           size * (epochs + CAST(chosen AS BIGINT)) AS taken
    FROM closed
"""
