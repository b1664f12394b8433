"""The trie of all conversations' prefixes, by van Emde Boas recursion on its depth.

A trie of height 2s is cut at half its depth.  Its upper half is a trie of height s, and
below each prefix of the cut hangs a lower one; both are cut again in the same way, until
they are one turn high.  All tries of one height are handled together, in one pass over a
table, so there are as many passes as the depth has binary digits, and a pass over tries of
height s has one row per s turns:

1. Upwards, stretches of s turns get a name from the names of their two halves.
2. Downwards, each prefix that ends at a cut is named by the prefix at which its trie
   begins and the stretch between them.  Each depth above 0 is the cut of exactly one height:
   that of its lowest binary digit.
3. Equal names are one node, known by its smallest conversation and its depth.
4. Totals are grafted upwards.  Of two nodes, one below the other, exactly one trie has the
   one in its upper and the other in its lower half.  So a lower trie's total is summed
   once into the node of its cut, and from there once into each node of the upper trie above
   it: two aggregates for all heights, and no pass per turn.

Names are 128 bits of SHA-256.  A group is always keyed by a conversation and a place in it,
or summed before it is shuffled, so neither one very long conversation nor a first turn
that many share lands in one task.  Tables between passes are written to the shared folder.

Defined results: a null role or text is empty.  Turns are ordered by ``turn``, null first, and
equal ones by a digest of role and text, so repeated rows are so many equal turns.  Rows
without a conversation's id belong to none and are left out.  Texts of any length count
whole.  An empty table gives no node, not even a root.  Of other columns none is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, stored, written
from millrace.plans.ordered import chunked, fold_count, running

LEAST_LONG = -(2**63)
NAME = ("high", "low")
# An end's list of conversations is joined from pieces of ids that share all but 12 bits.
ENDS_BITS = 12


def _bits(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("bigint")


def _named(*parts: Column) -> dict[str, Column]:
    """A name of 128 bits as two integers."""
    digest = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    return {"high": _bits(digest, 1), "low": _bits(digest, 17)}


def in_order(conversations: DataFrame) -> DataFrame:
    """Each turn's place from 1 on in its conversation, its name and its text's length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(LEAST_LONG)).alias("turn"),
        F.length(text).cast("bigint").alias("chars"),
        *[c.alias(n) for n, c in _named(F.length(role), role, text).items()],
    )
    parts = chunked(rows, ["turn", *NAME], keys=["conv_id"])
    placed = running(parts, {"depth": fold_count()})
    return placed.select("conv_id", "depth", *NAME, "chars")


def spliced(turns: DataFrame, every: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one does, and their numbers of turns.

    Conversation c takes its first h turns, or all if there are fewer, from conversation
    c - c % ``every``, none if that is absent, and goes on with its own turns after its
    first h; h is the CRC-32 of c in decimal, modulo ``heads``.
    """
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string")) % heads).cast("bigint")
    origin = conv - conv % every
    source = turns.where((origin == conv) & (F.col("depth") < heads)).select(
        conv.alias("__origin"), "depth", *NAME, "chars"
    )
    taken = turns.select("conv_id").distinct().withColumn("__origin", origin)
    begun = taken.join(source, "__origin").where(F.col("depth") <= head)
    begun = begun.select("conv_id", "depth", *NAME, "chars")
    # A conversation's own turns move up where its head is shorter than what it replaces.
    short = taken.join(source.groupBy("__origin").agg(F.count("*").alias("__n")), "__origin", "left")
    gap = head - F.coalesce(F.col("__n"), F.lit(0))
    short = short.where(gap > 0).select("conv_id", gap.alias("__gap"))
    rest = turns.where(F.col("depth") > head).join(short, "conv_id", "left")
    place = F.col("depth") - F.coalesce(F.col("__gap"), F.lit(0))
    rest = rest.select("conv_id", place.alias("depth"), *NAME, "chars")
    rows = written(begun.unionByName(rest), "trie-turns")
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("size"))
    sizes = taken.select("conv_id").join(sizes, "conv_id", "left")
    return rows, sizes.select("conv_id", F.coalesce("size", F.lit(0)).alias("size"))


def _stretches(turns: DataFrame, heights: int) -> list:
    """Names of all whole stretches of 1, 2, 4 ... turns that begin at a multiple of it."""
    single = turns.select("conv_id", (F.col("depth") - 1).alias("at"), *NAME, "chars")
    levels = [stored(single, "trie-stretches")]
    even = F.col("at") % 2 == 0
    for _ in range(1, heights):
        pairs = levels[-1].rows.groupBy(
            "conv_id", F.shiftright("at", 1).alias("at")
        ).agg(
            F.count("*").alias("n"),
            *[F.max(F.when(even, F.col(c))).alias(f"left_{c}") for c in NAME],
            *[F.max(F.when(~even, F.col(c))).alias(f"right_{c}") for c in NAME],
            F.max(F.when(~even, F.col("chars"))).alias("chars"),
        )
        halves = [F.col(f"{side}_{c}") for side in ("left", "right") for c in NAME]
        whole = pairs.where("n = 2").select(
            "conv_id", "at", *[c.alias(n) for n, c in _named(*halves).items()], "chars"
        )
        levels.append(stored(whole, "trie-stretches"))
    return levels


def named_prefixes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The name of each conversation's prefix of each depth, and its last text's length."""
    deepest = sizes.agg(F.max("size")).first()[0] or 0
    zero = F.lit(0).cast("bigint")
    roots = sizes.select(
        "conv_id", zero.alias("depth"), zero.alias("high"), zero.alias("low"), zero.alias("chars")
    )
    prefixes = written(roots, "trie-prefixes")
    levels = _stretches(turns, deepest.bit_length())
    for height in reversed(range(len(levels))):
        size = 1 << height
        # The upper half of a trie begins where the trie does, at an even stretch.
        upper = levels[height].rows.where("at % 2 = 0").select(
            "conv_id",
            (F.col("at") * size).alias("depth"),
            *[F.col(c).alias(f"own_{c}") for c in NAME],
            F.col("chars").alias("own_chars"),
        )
        begins = prefixes.select("conv_id", "depth", *NAME)
        name = _named(*[F.col(c) for c in (*NAME, "own_high", "own_low")])
        cut = begins.join(upper, ["conv_id", "depth"]).select(
            "conv_id",
            (F.col("depth") + size).alias("depth"),
            *[c.alias(n) for n, c in name.items()],
            F.col("own_chars").alias("chars"),
        )
        prefixes = prefixes.unionByName(written(cut, "trie-prefixes"))
        levels[height].discard()
    return prefixes


def _cuts_above(depth: Column, digits: int) -> Column:
    """Depths of the cuts with ``depth`` below them in the lower half: one per digit."""
    above = depth - 1
    cuts = [
        F.when(
            above.bitwiseAND(F.lit(1 << d).cast("bigint")) != 0,
            F.shiftleft(F.shiftright(above, d), d),
        )
        for d in range(digits)
    ]
    return F.array_compact(F.array(*cuts).cast("array<bigint>"))


def _upper_depths(cut: Column) -> Column:
    """The depths between the beginning of a cut's trie and the cut."""
    lowest = cut.bitwiseAND(-cut)
    return F.sequence(cut - lowest + 1, cut, F.lit(1).cast("bigint"))


SUMS = ("n_leaves", "saved_tokens")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def _grafted(own: DataFrame, paths: DataFrame, digits: int) -> DataFrame:
    """Each node's sums over all nodes below it.

    ``paths`` has the node of each smallest conversation's prefixes.  Sums are made by
    conversation first, so that it is looked up once per depth.
    """

    def moved(sums: DataFrame, depths: Column) -> DataFrame:
        at = sums.select("conv_id", F.explode(depths).alias("depth"), *SUMS)
        by_place = _summed(at, "conv_id", "depth").join(paths, ["conv_id", "depth"])
        by_node = by_place.select(F.col("node").alias("conv_id"), "depth", *SUMS)
        return _summed(by_node, "conv_id", "depth")

    lower = moved(own, _cuts_above(F.col("depth"), digits))
    return moved(lower, _upper_depths(F.col("depth")))


ENDS = "depth BIGINT, high BIGINT, low BIGINT, ends_sha256 STRING"


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces in their order; a node's pieces lie together."""
    node, digest = None, None

    def result(node: tuple, digest) -> pa.RecordBatch:
        columns = [pa.array([v], pa.int64()) for v in node]
        text = pa.array([digest.hexdigest()])
        return pa.RecordBatch.from_arrays([*columns, text], ["depth", *NAME, "ends_sha256"])

    for batch in batches:
        done = []
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for i, key in enumerate(zip(*columns)):
            piece = batch.column(3)[i].as_py().encode()
            if key == node:
                digest.update(b"," + piece)
                continue
            if node is not None:
                done.append(result(node, digest))
            node, digest = key, hashlib.sha256(piece)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if node is not None:
        yield result(node, digest)


def _ends(prefixes: DataFrame, sizes: DataFrame) -> DataFrame:
    """A digest of the conversations that end at each node.

    A digest is sequential by its nature, so one task goes through a node's ids; it
    streams them in pieces of at most 4,096, which are made before.
    """
    last = sizes.select("conv_id", F.col("size").alias("depth"))
    ids = prefixes.join(last, ["conv_id", "depth"])
    pieces = ids.groupBy("depth", *NAME, F.shiftright("conv_id", ENDS_BITS).alias("__piece")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    sorted_pieces = (
        pieces.repartition("depth", *NAME)
        .sortWithinPartitions("depth", *NAME, "__piece")
        .select("depth", *NAME, "ids")
    )
    return arrow_map(sorted_pieces, _hashed_ends, ENDS)


def nodes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node of the trie; ``turns`` as ``in_order`` gives them.

    ``sizes`` has every conversation with its number of turns, 0 included.
    """
    prefixes = named_prefixes(turns, sizes)
    ends = _ends(prefixes, sizes)
    found = written(
        prefixes.groupBy("depth", *NAME).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("chars").alias("chars"),
        ),
        "trie-nodes",
    )
    below_root = found.where("depth > 0")
    smallest = below_root.select("conv_id").distinct()
    paths = written(
        prefixes.where("depth > 0")
        .join(smallest, "conv_id", "left_semi")
        .join(below_root.select("depth", *NAME, F.col("conv_id").alias("node")), ["depth", *NAME])
        .select("conv_id", "depth", "node"),
        "trie-paths",
    )
    # Paths begin at depth 1; every first turn's parent is the root, that of all.
    root, deepest = found.agg(F.min("conv_id"), F.max("depth")).first()
    root = F.lit(root).cast("bigint")
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), "node")
    child = found.join(above, ["conv_id", "depth"], "left")
    parent = F.when(F.col("depth") == 1, root).otherwise(F.col("node"))
    child = child.withColumn("parent_conv_id", F.when(F.col("depth") > 0, parent))
    children = (
        child.where("depth > 0")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("n_children"))
    )
    whole = written(
        child.join(children, ["conv_id", "depth"], "left")
        .join(ends, ["depth", *NAME], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ),
        "trie-whole",
    )
    own = whole.where("depth > 0").select("conv_id", "depth", *SUMS)
    grafted = _grafted(own, paths, (deepest or 0).bit_length())
    of_root = own.agg(*[F.sum(c).alias(c) for c in SUMS])
    of_root = of_root.withColumns({"conv_id": root, "depth": F.lit(0).cast("bigint")})
    below = grafted.unionByName(of_root)
    below = below.select("conv_id", "depth", *[F.col(c).alias(f"below_{c}") for c in SUMS])
    added = {c: F.col(c) + F.coalesce(f"below_{c}", F.lit(0)) for c in SUMS}
    return (
        whole.join(below, ["conv_id", "depth"], "left")
        .withColumns(added)
        .select(*whole.columns)
    )


def crc32_sql(digits: str) -> str:
    """The CRC-32 of a text of ASCII characters, for engines without that function."""
    steps = f"""flatten(list_transform(range(1, length({digits}) + 1),
                lambda i: [ascii(substr({digits}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))"""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {steps}::BIGINT[]),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                          WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""


ORACLE = f"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS d
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY d) AS turns,
           CAST({crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS head
    FROM placed GROUP BY conv_id
),
built AS (
    SELECT c.conv_id, list_concat(coalesce(o.turns[1:c.head], []), c.turns[c.head + 1:]) AS turns
    FROM own AS c LEFT JOIN own AS o ON o.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (
    SELECT conv_id, len(turns) AS size, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built
),
nodes AS (
    SELECT min(conv_id) AS conv_id, depth, turns[1:depth] AS prefix, count(*) AS n_convs,
           sha256(coalesce(string_agg(CASE WHEN size = depth THEN CAST(conv_id AS VARCHAR) END,
                                      ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, turns[1:depth]
),
children AS (
    SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY 1, 2
),
counted AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0
                ELSE (n_convs - 1) * length(prefix[depth].text) END AS own_saved
    FROM nodes AS n LEFT JOIN children AS c USING (depth, prefix)
),
reached AS (
    SELECT unnest(range(0, depth + 1)) AS above, prefix, n_children, own_saved FROM counted
),
subtrees AS (
    SELECT above AS depth, prefix[1:above] AS prefix,
           CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
           CAST(sum(own_saved) AS BIGINT) AS saved_tokens
    FROM reached GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted AS n JOIN subtrees AS s USING (depth, prefix)
LEFT JOIN nodes AS p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
