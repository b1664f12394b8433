"""The best documents for each query text, exactly, by buckets of vector length.

A document is a vector of impacts: for each of its terms that some query has, the term's
weight times a share that grows with its occurrences and shrinks with the document's size.
A query is the vector with a one for each of its terms, so a score is their product.

1. One pass counts documents and terms, and the documents that hold each term of the queries.
2. A second pass writes the vectors, the longest first within each file.
3. Buckets of falling length are searched one after another, the longest 1/64 first, then up
   to 1/16, 1/4 and all.  After each, a query's threshold is its k-th best score so far.  By the
   Cauchy-Schwarz inequality no vector scores more than its length times the query's; a query
   for which the next bucket's longest vectors can't reach the threshold is done.
4. Within a bucket tasks go on in smaller ones, a batch each, with thresholds of their own
   finds.  The largest impact of each coordinate in a batch tells which terms a document must
   have at least one of; a document with some stays if those terms' impacts, and a bound
   for the rest, reach the threshold: the lesser of the rest's largest impacts and of the
   product of what is left of both lengths.
5. What stays is scored again, in integers.

Bounds are rounded up, and reaching a threshold is enough, so no result is lost, and equal
scores are decided by id.  Queries come in blocks of bounded size, sorted by id.  The driver
holds a block's terms and its best documents, never a document's text or vector.  Only counts
and best scores are shuffled, so copies and frequent terms don't fill one task.

Defined results: a null text has no terms; a document without terms counts for nothing; texts
are read whole.  Rows with one id are documents of their own, and may both be listed; queries
with one id, null included, are one query with all their terms.  Equal scores are ordered by
id, null last.  An empty table on either side gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import arrow_map, stored, written

BLOCK_ITEMS, BLOCK_BYTES = 512, 8 << 20
# Shares of the vectors, longest first, after which thresholds are taken anew.
SHARES = (1 / 64, 1 / 16, 1 / 4)
BATCH_ROWS = 4000
SLACK = 1 + 1e-9

# A-Z in lower case; every other byte below 0x80 but a-z and 0-9 parts terms.
BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(BYTES).split()


@dataclass
class Block:
    """Some queries, with numbers for their terms."""

    ids: list = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    size: int = 0

    def add(self, item_id, found: set[bytes]) -> None:
        self.ids.append(item_id)
        numbers = [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in sorted(found)]
        self.items.append(np.array(numbers, np.int64))
        self.size += sum(map(len, found)) + 8 * len(found)


def blocks(queries: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    rows = queries.select(F.col(item_id).alias("id"), F.col(text).cast("binary").alias("text"))
    block, current, found = Block(), None, None
    for row in rows.orderBy("id").toLocalIterator():
        if found is not None and row.id != current:
            block.add(current, found)
            found = None
            if len(block.ids) >= BLOCK_ITEMS or block.size >= BLOCK_BYTES:
                yield block
                block = Block()
        current, found = row.id, (found or set()) | set(terms(bytes(row.text or b"")))
    if found is not None:
        block.add(current, found)
        yield block


def _term_numbers(texts: pa.Array, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, ...]:
    """Each document's number of terms; and (document, term number, occurrences)."""
    sizes, rows, numbers = [], [], []
    for row, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        found = terms(text or b"")
        sizes.append(len(found))
        known = np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int64, len(found))
        known = known[known >= 0]
        numbers.append(known)
        rows.append(np.full(len(known), row, np.int64))
    width = max(len(vocabulary), 1)
    keys = np.concatenate(rows) * width + np.concatenate(numbers) if rows else np.empty(0, np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    return np.array(sizes, np.int64), keys // width, keys % width, counts


@dataclass
class Statistics:
    documents: int
    terms: int
    holders: np.ndarray

    def weights(self) -> np.ndarray:
        """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
        return np.array(
            [math.floor(1000 * math.log((2 * self.documents + 2) / (2 * h + 1))) for h in self.holders.tolist()],
            np.int64,
        )

    def impacts(self, sizes: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
        """(10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L."""
        exact = 90 * int(sizes.max(initial=0)) * self.documents < 2**63
        wide = sizes if exact else sizes.astype(object)
        spread = 10 + (90 * wide * self.documents // max(self.terms, 1)).astype(np.int64)
        return 1_000_000_000 * occurrences // (1000 * occurrences + 8 * spread)


def counted(documents: DataFrame, vocabulary: dict[bytes, int]) -> Statistics:
    """Counts over all documents; each task sends one row per term it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders, total, words = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            sizes, _, numbers, _ = _term_numbers(batch.column(0), vocabulary)
            holders += np.bincount(numbers, minlength=len(vocabulary))
            total += int((sizes > 0).sum())
            words += int(sizes.sum())
        met = np.flatnonzero(holders)
        columns = [np.concatenate([[-2, -1], met]), np.concatenate([[total, words], holders[met]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "n"])

    counts = arrow_map(documents.select("text"), count, "term BIGINT, n BIGINT", BATCH_ROWS)
    sums = dict(map(tuple, counts.groupBy("term").agg(F.sum("n")).collect()))
    holders = np.array([sums.get(i, 0) for i in range(len(vocabulary))], np.int64)
    return Statistics(sums.get(-2, 0), sums.get(-1, 0), holders)


VECTORS = "doc_id BIGINT, length DOUBLE, terms ARRAY<INT>, impacts ARRAY<INT>"


def vectors(documents: DataFrame, vocabulary: dict[bytes, int], statistics: Statistics) -> DataFrame:
    """Documents with a term of the queries: length, term numbers and unweighted impacts."""
    weights = statistics.weights()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rows, numbers, occurrences = _term_numbers(batch.column(1), vocabulary)
            impacts = statistics.impacts(sizes[rows], occurrences)
            squares = (weights[numbers] * impacts).astype(np.float64) ** 2
            lengths = np.sqrt(np.bincount(rows, squares, len(sizes)))
            ends = np.searchsorted(rows, np.arange(len(sizes) + 1)).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(values, pa.int32()))
                for values in (numbers, impacts)
            ]
            columns = [batch.column(0).cast(pa.int64()), pa.array(lengths), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms", "impacts"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = arrow_map(rows, build, VECTORS, BATCH_ROWS).where("length > 0")
    return found.sortWithinPartitions(F.desc("length"))


@dataclass
class Bucket:
    """A batch of vectors, with the entries of each term."""

    lengths: np.ndarray
    rows: np.ndarray
    impacts: np.ndarray
    starts: np.ndarray
    largest: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, weights: np.ndarray) -> Bucket:
        lists = batch.column(2)
        numbers = lists.flatten().to_numpy().astype(np.int64)
        shares = batch.column(3).flatten().to_numpy().astype(np.int64)
        sizes = np.diff(lists.offsets.to_numpy())
        rows = np.repeat(np.arange(batch.num_rows), sizes)
        by_term = np.argsort(numbers, kind="stable")
        starts = np.searchsorted(numbers[by_term], np.arange(len(weights) + 1))
        impacts = (weights[numbers] * shares)[by_term]
        largest = np.zeros(len(weights), np.int64)
        np.maximum.at(largest, numbers[by_term], impacts)
        return Bucket(batch.column(1).to_numpy(), rows[by_term], impacts, starts, largest)

    def _entries(self, terms: np.ndarray) -> np.ndarray:
        spans = [np.arange(self.starts[t], self.starts[t + 1]) for t in terms.tolist()]
        return np.concatenate(spans) if spans else np.empty(0, np.int64)

    def survivors(self, item: np.ndarray, threshold: int) -> np.ndarray:
        """Rows that may score ``threshold`` or more, and more than 0."""
        if math.sqrt(len(item)) * self.lengths.max(initial=0) * SLACK < threshold:
            return np.empty(0, np.int64)
        item = item[np.argsort(self.largest[item], kind="stable")]
        reach = np.cumsum(self.largest[item])
        # Terms that don't reach the threshold even all together are not enough for a row.
        rest = int(np.searchsorted(reach, threshold)) if threshold > 0 else 0
        entries = self._entries(item[rest:])
        rows, impacts = self.rows[entries], self.impacts[entries].astype(np.float64)
        sums = np.bincount(rows, impacts, len(self.lengths))
        left = self.lengths**2 * SLACK - np.bincount(rows, impacts**2, len(self.lengths))
        by_length = math.sqrt(rest) * np.sqrt(np.maximum(left, 0)) * SLACK
        by_coordinate = float(reach[rest - 1]) if rest else 0.0
        bound = sums + np.minimum(by_length, by_coordinate)
        return np.flatnonzero((sums > 0) & (bound * SLACK >= threshold))

    def scores(self, item: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The exact scores of the chosen rows."""
        entries = self._entries(item)
        totals = np.zeros(len(self.lengths), np.int64)
        np.add.at(totals, self.rows[entries], self.impacts[entries])
        return totals[chosen]


FOUND = "item INT, doc_id BIGINT, score BIGINT"


def _best(rows: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    """The k best of (score, doc_id): equal scores by id, null last."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]


def _searched(
    bucket: DataFrame, items: dict[int, np.ndarray], weights: np.ndarray, floor: dict[int, int], k: int
) -> DataFrame:
    """For each task and item, the task's best documents that reach the item's threshold."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {number: [] for number in items}
        for batch in batches:
            rows, ids = Bucket.of(batch, weights), batch.column(0).to_pylist()
            for number, item in items.items():
                own = best[number][-1][0] if len(best[number]) == k else 0
                threshold = max(floor[number], own)
                chosen = rows.survivors(item, threshold)
                if not len(chosen):
                    continue
                scores = rows.scores(item, chosen)
                reached = scores >= max(threshold, 1)
                chosen, scores = chosen[reached], scores[reached]
                if len(chosen) > k:
                    # All that tie with the k-th best of the batch go on to be told apart by id.
                    least = np.partition(scores, -k)[-k]
                    chosen, scores = chosen[scores >= least], scores[scores >= least]
                fresh = [(s, ids[c]) for s, c in zip(scores.tolist(), chosen.tolist())]
                best[number] = _best(best[number] + fresh, k)
        found = [(number, i, s) for number, rows in best.items() for s, i in rows]
        columns = list(zip(*found)) or [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    found = arrow_map(bucket, search, FOUND, BATCH_ROWS)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(documents: DataFrame, block: Block, k: int) -> list[tuple]:
    """(item id, rank, doc_id, score) of a block's queries."""
    statistics = counted(documents, block.vocabulary)
    weights = statistics.weights()
    items = {n: terms[(weights * (statistics.holders > 0))[terms] > 0] for n, terms in enumerate(block.items)}
    items = {n: terms for n, terms in items.items() if len(terms)}
    if not items:
        return []
    table = stored(vectors(documents, block.vocabulary, statistics), "impact-vectors")
    cuts = table.rows.approxQuantile("length", [1 - s for s in SHARES], 0.001) or [0.0]
    best: dict[int, list] = {n: [] for n in items}
    floor = dict.fromkeys(items, 0)
    upper = math.inf
    for lower in [*cuts, 0.0]:
        # The next bucket's vectors are no longer than the last one's lower end.
        open_items = {
            n: terms
            for n, terms in items.items()
            if math.isinf(upper) or math.sqrt(len(terms)) * upper * SLACK >= floor[n]
        }
        if lower >= upper or not open_items:
            continue
        bucket = table.rows.where((F.col("length") >= lower) & (F.col("length") < upper))
        for row in _searched(bucket, open_items, weights, floor, k).collect():
            best[row.item].append((row.score, row.doc_id))
        for n in open_items:
            best[n] = _best(best[n], k)
            floor[n] = best[n][-1][0] if len(best[n]) == k else 0
        upper = lower
    table.discard()
    return [
        (block.ids[n], rank, doc_id, score)
        for n, rows in best.items()
        for rank, (score, doc_id) in enumerate(rows, 1)
    ]


def ranked(
    documents: DataFrame, queries: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 of each query, and their ranks."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text")
    schema = T.StructType(
        [
            queries.schema[item_id],
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )
    results = spark.createDataFrame([], schema)
    for block in blocks(queries, item_id, text):
        found = spark.createDataFrame(_ranked(texts, block, k), schema)
        results = results.unionByName(written(found, "ranked"))
    return results


TERM_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, {TERM_SQL} AS terms FROM documents
),
sized AS (SELECT row, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS words FROM sized),
counts AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM sized)
    GROUP BY row, term
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, documents
),
items AS (SELECT DISTINCT item_id, unnest({TERM_SQL}) AS term FROM benchmark),
scores AS (
    SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf)
               // (1000 * tf + 8 * (10 + (90 * n * documents) // words)))) AS BIGINT) AS score
    FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN sized USING (row), totals
    GROUP BY item_id, doc_id, row
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0
) WHERE rank <= 10
"""
