"""Benchmark decontamination by latent semantic retrieval.

The benchmark's passages make a TF-IDF matrix, whose document frequencies are counted
over all documents.  A randomised SVD, its products summed over Spark tasks, gives a
latent space in which each item passage is a vector.  Documents are cut into overlapping
passages of ``WINDOW`` words that are folded into this space; a passage whose cosine with
an item's is ``COSINE`` or more is a candidate, and so is one that shares ``LEAST`` of an
item's words, or of ``STEP`` words for longer items, however usual these are in the
documents: a copy with up to 40 % of its words replaced or left out always has such a
passage.  The longest common subsequence of words decides: an item is found if ``NEAR`` of its words stand there in order, or if ``LEAST``
of them do and its answer, the last sentence, is there as well.

The decomposed matrix is that of the benchmark: the corpus's own main directions are its
common words, and would lose the rare ones that tell items apart.  Words that no item has
have no place in the latent space.  Every passage is looked up, but for stretches in which,
with all words around that it would be compared with, no item has ``LEAST`` of its words:
there nothing could be found.

Items are taken in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words, so
what tasks are sent has a bound whatever the benchmark's size.  Nothing is shuffled but
document frequencies.

Defined results: null texts and items count as empty, and nothing is found in or by them;
null document ids are kept; an item with a null id is not used; repeated rows are all
returned; without items nothing is found; an empty table gives no rows.  Columns named
like added ones are replaced, others kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, written

WINDOW = 32
STEP = 16
DIMENSIONS = 256
SPARE = 8
ROUNDS = 2
COSINE = 0.4
NEAR = 0.8
LEAST = 0.6
ANSWER = 0.7
ANSWER_WORDS = 8
BLOCK_ITEMS = 1024
BLOCK_WORDS = 40_000
SLICE = 200
PART = 4096  # words looked up at once, a multiple of STEP
SPAN = 8  # passages at least that are ruled out together

# ASCII letters and digits stay, other ASCII characters become spaces.
WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(WORDS).split()


def common_length(masks: dict[bytes, int], n: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence of an item of n words and the words.

    ``masks`` has a bit for each place of a word in the item.
    """
    rows = full = (1 << n) - 1
    get = masks.get
    for word in words:
        mask = get(word)
        if mask:
            kept = rows & mask
            rows = ((rows + kept) | (rows - kept)) & full
    return n - rows.bit_count()


def masks_of(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


@dataclass
class Item:
    """A benchmark item, with its answer: the last sentence of several, else last words."""

    item_id: int
    text: str

    def __post_init__(self):
        self.words = words_of(self.text)
        self.masks = masks_of(self.words)
        self.places = Counter(self.words)
        sentences = [s for s in map(words_of, self.text.replace("\n", ".").split(".")) if s]
        answer = sentences[-1] if len(sentences) > 1 else []
        while len(answer) < min(3, len(self.words)) and len(sentences) > 1:
            sentences.pop()
            answer = sentences[-1] + answer
        self.answer = answer or self.words[-ANSWER_WORDS:]
        self.answer_masks = masks_of(self.answer)

    def may_be_in(self, words: list[bytes]) -> bool:
        """Whether enough of the item's words stand there, in whatever order."""
        shared = self.places.keys() & set(words)
        return sum(map(self.places.__getitem__, shared)) >= LEAST * len(self.words)

    def found_in(self, words: list[bytes]) -> float:
        """The share of the item's words that stand there, 0 if that isn't the item."""
        n = len(self.words)
        share = common_length(self.masks, n, words) / n
        if share >= NEAR:
            return share
        if share < LEAST:
            return 0.0
        m = len(self.answer)
        answered = common_length(self.answer_masks, m, words) >= ANSWER * m
        return share if answered else 0.0


def cut(n: int) -> list[tuple[int, int]]:
    """Places of the passages of n words."""
    return [(a, min(n, a + WINDOW)) for a in range(0, max(1, n - (WINDOW - STEP)), STEP)] if n else []


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[Item]]:
    held: list[Item] = []
    size = 0
    rows = benchmark.filter(F.col(item_id).isNotNull()).orderBy(item_id, text)
    for row in rows.select(item_id, text).toLocalIterator():
        item = Item(row[0], row[1] or "")
        if not item.words:
            continue
        if held and (len(held) == BLOCK_ITEMS or size + len(item.words) > BLOCK_WORDS):
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item.words)
    if held:
        yield held


def document_frequencies(documents: DataFrame, terms: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and of those that hold each of the terms."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        n = 0
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                for text in batch.column(0).slice(at, SLICE).to_pylist():
                    found.update(terms.intersection(words_of(text or "")))
            n += len(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b"", *found], pa.binary()), pa.array([n, *found.values()], pa.int64())],
            names=["term", "n"],
        )

    rows = documents.select("text").transform(arrow_map, counted, "term BINARY, n BIGINT")
    counts = {bytes(r["term"]): r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return counts.pop(b"", 0), counts


@dataclass
class Index:
    """A block's items, the terms' weighted latent rows, and the items' vectors."""

    items: list[Item]
    terms: dict[bytes, int]
    folds: np.ndarray
    passages: np.ndarray
    item_of: np.ndarray

    def __post_init__(self):
        counts = [(self.terms[w], i, m.bit_count()) for i, t in enumerate(self.items) for w, m in t.masks.items()]
        self.times = np.zeros(len(self.terms), np.int64)
        for term, _, n in counts:
            self.times[term] = max(n, self.times[term])
        self.times = np.minimum(self.times, WINDOW)
        self.first = np.cumsum(self.times) - self.times
        self.holds = np.zeros((self.times.sum(), len(self.items)), np.uint8)
        for term, i, n in counts:
            self.holds[self.first[term] : self.first[term] + min(n, WINDOW), i] = 1
        self.least = np.array([math.ceil(LEAST * min(len(i.words), STEP)) for i in self.items])
        sizes = [len(i.words) for i in self.items]
        self.reach = max(sizes)
        # As many words as both sides' reach, so that the areas around overlap at most twice.
        self.span = max(SPAN, -(-2 * self.reach // STEP))
        self.enough = np.array([math.ceil(LEAST * n) for n in sizes])
        self.counts = np.zeros((len(self.terms), len(self.items)), np.min_scalar_type(self.reach))
        for term, i, n in counts:
            self.counts[term, i] = n

    def found(self, words: list[bytes]) -> dict[int, float]:
        """The items in a document, with the share of their words."""
        n = len(words)
        outside = len(self.terms)
        at = np.fromiter(map(self.terms.get, words, repeat(outside)), np.int64, n)
        share: dict[int, float] = {}
        passages = max(1, -(-n // STEP) - 1)
        width = PART // STEP
        for first in range(0, passages, max(1, width // self.span) * self.span):
            end = min(passages, first + max(1, width // self.span) * self.span)
            possible = self._possible(at, first, end)
            rows = self._near(words, at, first, end, possible)
            some = np.flatnonzero(rows.any(axis=1))
            # One search for passages with small gaps between them.
            for run in np.split(some, np.flatnonzero(np.diff(some) > SPAN) + 1) if len(some) else []:
                for a in range(int(run[0]), int(run[-1]) + 1, width):
                    b = min(int(run[-1]) + 1, a + width)
                    start = (first + a) * STEP
                    self._find(words, at[start : (first + b + 1) * STEP], start, rows[a:b], share)
        return share

    def _possible(self, at: np.ndarray, first: int, end: int) -> np.ndarray:
        """Which items (columns) have enough words near some passages (rows: ``span`` each).

        All words that an item of a passage is compared with are counted, so what is ruled
        out could not be found there.
        """
        starts = np.arange(first, end, self.span) * STEP
        low = np.maximum(0, starts - self.reach)
        high = starts + (self.span - 1) * STEP + WINDOW + self.reach
        area = at[low[0] : high[-1]]
        places = np.flatnonzero(area < len(self.terms))
        begin, stop = np.searchsorted(places, low - low[0]), np.searchsorted(places, high - low[0])
        sizes = stop - begin
        inside = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        key = np.repeat(np.arange(len(starts)) * len(self.terms), sizes) + area[places[inside]]
        seen = np.zeros(len(starts) * len(self.terms), bool)
        seen[key] = True
        group, term = np.divmod(np.flatnonzero(seen), len(self.terms))
        possible = np.zeros((len(starts), len(self.items)), bool)
        if len(group):
            held, begin = np.unique(group, return_index=True)
            words = np.add.reduceat(self.counts[term], begin, axis=0)
            possible[held] = words >= self.enough
        return possible

    def _near(
        self, words: list[bytes], at: np.ndarray, first: int, end: int, possible: np.ndarray
    ) -> np.ndarray:
        """Which of the possible items (columns) have enough words near each passage (rows)."""
        rows = np.zeros((end - first, len(self.items)), bool)
        for group, i in zip(*(x.tolist() for x in np.nonzero(possible)), strict=True):
            a, b = first + group * self.span, min(end, first + (group + 1) * self.span)
            reach = len(self.items[i].words)
            starts = np.arange(a, b) * STEP
            low, high = np.maximum(0, starts - reach), starts + WINDOW + reach
            area = at[low[0] : high[-1]]
            places = np.flatnonzero(area < len(self.terms))
            times = np.concatenate([[0], np.cumsum(self.counts[area[places], i])])
            begin, stop = np.searchsorted(places, low - low[0]), np.searchsorted(places, high - low[0])
            # Repeated words count each time here, so this is never too little.
            for k in np.flatnonzero(times[stop] - times[begin] >= self.enough[i]).tolist():
                region = words[low[k] : high[k]]
                rows[a + k - first, i] = self.items[i].may_be_in(region)
        return rows

    def _find(
        self, words: list[bytes], at: np.ndarray, first: int, possible: np.ndarray, share: dict[int, float]
    ) -> None:
        """Add the items near the passages of the words' part that starts at first.

        Passages and items are paired only where that is possible.
        """
        places = np.flatnonzero(at < len(self.terms))
        known, step = at[places], places // STEP
        passages = max(1, -(-len(at) // STEP) - 1)
        held, begin = np.unique(step, return_index=True)
        folded = np.zeros((passages + 1, self.folds.shape[1]), np.float32)
        folded[held] = np.add.reduceat(self.folds[known], begin, axis=0)
        folded = folded[:-1] + folded[1:]
        length = np.linalg.norm(folded, axis=1, keepdims=True)
        near, row = np.nonzero((folded @ self.passages.T >= COSINE * length) & (length > 0))
        near, item = near[keep := possible[near, self.item_of[row]]], self.item_of[row[keep]]
        pairs = set(zip(near.tolist(), item.tolist(), strict=True))
        # Each word of a passage once, the k-th time as the item's k-th.
        passage = np.concatenate([step, step - 1])
        key = (passage * len(self.terms) + np.tile(known, 2))[(passage >= 0) & (passage < passages)]
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        time = np.arange(len(key)) - np.repeat(new, np.diff(new, append=len(key)))
        passage, term = np.divmod(key, len(self.terms))
        used = time < self.times[term]
        passage, place = passage[used], self.first[term[used]] + time[used]
        held, begin = np.unique(passage, return_index=True)
        shared = np.add.reduceat(self.holds[place], begin, axis=0)
        near, item = np.nonzero((shared >= self.least) & possible[held])
        for w, i in zip(held[near].tolist(), item.tolist(), strict=True):
            item, start = self.items[i], first + w * STEP
            inside = common_length(item.masks, len(item.words), words[start : start + WINDOW])
            if inside >= self.least[i]:
                pairs.add((w, i))
        for w, i in pairs:
            item, start = self.items[i], first + w * STEP
            reach = len(item.words)
            region = words[max(0, start - reach) : start + WINDOW + reach]
            if s := item.found_in(region):
                share[item.item_id] = max(s, share.get(item.item_id, 0.0))


def _products(rows: DataFrame, base: np.ndarray) -> np.ndarray:
    """A' A base for the matrix A whose rows have term numbers and weights."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros_like(base)
        for batch in batches:
            for terms, weights in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                t, w = np.array(terms), np.array(weights)
                sums[t] += w[:, None] * (w @ base[t])
        touched = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(touched, pa.int64()), pa.array([sums[t].tobytes() for t in touched], pa.binary())],
            names=["term", "sums"],
        )

    total = np.zeros_like(base)
    for row in rows.transform(arrow_map, product, "term BIGINT, sums BINARY").collect():
        total[row["term"]] += np.frombuffer(bytes(row["sums"]), base.dtype)
    return total


def randomised_svd(rows: DataFrame, n_terms: int, dimensions: int, seed: int = 7) -> np.ndarray:
    """The first right singular vectors of the rows' matrix, as columns."""
    width = min(n_terms, dimensions + SPARE)
    base = np.random.default_rng(seed).standard_normal((n_terms, width))
    for _ in range(ROUNDS):
        base, _ = np.linalg.qr(_products(rows, base))
    values, turn = np.linalg.eigh(base.T @ _products(rows, base))
    return (base @ turn)[:, np.argsort(-values)][:, :dimensions]


def build_index(documents: DataFrame, items: list[Item], dimensions: int = DIMENSIONS) -> Index:
    spark = documents.sparkSession
    names = sorted({w for item in items for w in item.words})
    terms = {w: i for i, w in enumerate(names)}
    n, counts = document_frequencies(documents, frozenset(names))
    rarity = [math.log((n + 1) / (counts.get(w, 0) + 1)) + 0.01 for w in names]
    weights = np.array(rarity)
    item_of, rows = [], []
    for i, item in enumerate(items):
        for start, end in cut(len(item.words)):
            held = Counter(terms[w] for w in item.words[start:end])
            scaled = np.array([weights[t] * c for t, c in held.items()])
            item_of.append(i)
            rows.append((list(held), (scaled / np.linalg.norm(scaled)).tolist()))
    table = written(
        spark.createDataFrame(rows, "terms ARRAY<BIGINT>, weights ARRAY<DOUBLE>"), "benchmark-passages"
    )
    latent = randomised_svd(table, len(names), dimensions)
    passages = np.stack([np.array(w) @ latent[t] for t, w in rows])
    passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-12)
    return Index(
        items,
        terms,
        (weights[:, None] * latent).astype(np.float32),
        passages.astype(np.float32),
        np.array(item_of),
    )


def searched(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents with ``items``: item_id and share of each item found, by item_id."""
    found = documents.drop("items").withColumn(
        "items", F.array().cast("array<struct<item_id: bigint, share: double>>")
    )
    texts = documents.select(F.col(text).alias("text"))
    for block in blocks(benchmark, item_id, item_text):
        index = build_index(texts, block)

        def look_up(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                body, before = batch.column(text), batch.column("items").to_pylist()
                after = []
                for at in range(0, len(batch), SLICE):
                    for value, held in zip(
                        body.slice(at, SLICE).to_pylist(), before[at : at + SLICE], strict=True
                    ):
                        # Rows of one item may lie in two blocks.
                        best = {r["item_id"]: r["share"] for r in held}
                        for item, share in index.found(words_of(value or "")).items():
                            best[item] = max(share, best.get(item, 0.0))
                        after.append([{"item_id": i, "share": s} for i, s in sorted(best.items())])
                column = batch.schema.get_field_index("items")
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
                yield batch.set_column(column, "items", pa.array(after, kind))

        found = found.transform(arrow_map, look_up, found.schema)
    return found
