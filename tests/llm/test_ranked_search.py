import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, queries, k=10):
    counts = [(i, Counter(words(t))) for i, t in documents]
    counts = [(i, c) for i, c in counts if c]
    total, size = len(counts), sum(sum(c.values()) for _, c in counts)
    holders = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in holders.items()}
    merged = {}
    for item, text in queries:
        merged.setdefault(item, set()).update(words(text))
    rows = []
    for item, terms in merged.items():
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * total) // size
            score = sum(
                weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, i, -score))
    return sorted(rows, key=repr)


def found(spark, documents, queries, k=10):
    docs = spark.createDataFrame(documents, "doc_id BIGINT, text STRING")
    items = spark.createDataFrame(queries, "item_id BIGINT, text STRING")
    return sorted((tuple(r) for r in ranked_search.ranked(docs, items, k).collect()), key=repr)


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [
        (i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 20, 200]))))
        for i in range(n)
    ]


def test_terms():
    text = "Aß-Ünd\x7fx9_ÀZ é y z\x00Ω"
    assert [t.decode() for t in ranked_search.terms(text.encode())] == words(text)
    assert words(text) == ["aß", "Ünd", "x9", "Àz", "é y z", "Ω"]


def test_random_documents(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BATCH_ROWS", 40)
    rng = random.Random(1)
    documents = corpus(rng, 900)
    queries = [(i, " ".join(text.split()[:25])) for i, text in documents[:40]] + [(99, "unknown !"), (98, "")]
    assert found(spark, documents, queries) == brute(documents, queries)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 3)
    rng = random.Random(2)
    documents = corpus(rng, 120)
    queries = [(i % 7, text) for i, text in documents[:11]] + [(None, "w1 w2"), (None, "w3")]
    assert found(spark, documents, queries, 4) == brute(documents, queries, 4)


def test_ties_copies_and_nulls(spark):
    documents = [(i, "one two three") for i in range(60, 0, -1)]
    documents += [(5, "one two three"), (None, "one two three"), (7, None), (8, ""), (9, "four" * 9)]
    queries = [(1, "two"), (2, "FOUR four"), (3, "fourfourfourfourfourfourfourfourfour one")]
    assert found(spark, documents, queries) == brute(documents, queries)
    few = [(None, "one"), (2, "one two"), (None, "one"), (3, "zwei")]
    assert found(spark, few, [(1, "ONE")]) == brute(few, [(1, "one")])


def test_a_word_in_most_documents_and_a_long_text(spark):
    rng = random.Random(4)
    documents = [(i, f"the the {t}") for i, t in corpus(rng, 300)]
    documents.append((1000, "the " * 300_000 + "w7 rare"))
    queries = [(1, "the"), (2, "the rare w7 w250"), (3, "w7 w8 w9 the")]
    assert found(spark, documents, queries) == brute(documents, queries)


def test_empty_tables_and_other_columns(spark):
    assert found(spark, [], [(1, "a")]) == found(spark, [(1, "a")], []) == []
    docs = spark.createDataFrame(
        [(1, "a b", "x", 2.0), (2, "b", "y", 1.0)],
        "doc_id BIGINT, text STRING, terms STRING, length DOUBLE",
    )
    items = spark.createDataFrame([(4, "b", 9, 1)], "item_id BIGINT, text STRING, score INT, rank INT")
    rows = ranked_search.ranked(docs, items)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    assert [r.doc_id for r in rows.orderBy("rank").collect()] == [r[2] for r in brute([(1, "a b"), (2, "b")], [(4, "b")])]


def test_bounds_prune_and_lose_nothing():
    """A bucket keeps every row that reaches the threshold, and drops most others."""
    rng = np.random.default_rng(6)
    terms = [np.unique(rng.zipf(1.4, 30) % 200) for _ in range(500)]
    holders = np.bincount(np.concatenate(terms), minlength=200)
    weights = ranked_search.Statistics(500, 15_000, holders).weights()
    shares = [rng.integers(100_000, 900_000, len(t)) for t in terms]
    lengths = [math.sqrt(sum((weights[t] * s).astype(float) ** 2)) for t, s in zip(terms, shares)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(500), pa.int64()),
            pa.array(lengths),
            pa.array([t.tolist() for t in terms], pa.list_(pa.int32())),
            pa.array([s.tolist() for s in shares], pa.list_(pa.int32())),
        ],
        ["doc_id", "length", "terms", "impacts"],
    )
    bucket = ranked_search.Bucket.of(batch, weights)
    kept = 0
    for _ in range(40):
        item = rng.choice(200, 12, replace=False)
        everything = bucket.scores(item, np.arange(500))
        threshold = int(np.sort(everything)[-10])
        if threshold == 0:
            continue
        chosen = bucket.survivors(item, threshold)
        assert set(np.flatnonzero(everything >= threshold)) <= set(chosen)
        kept += len(chosen)
        assert len(bucket.survivors(item, 10**15)) == 0
    assert kept < 40 * 500 / 4


@pytest.mark.parametrize("sizes", [[5, 1], [10**8]])
def test_large_counts_do_not_overflow(sizes):
    statistics = ranked_search.Statistics(10**11, 10**13, np.array([3]))
    found = statistics.impacts(np.array(sizes, np.int64), np.ones(len(sizes), np.int64))
    m = [10 + 90 * n * 10**11 // 10**13 for n in sizes]
    assert found.tolist() == [10**9 // (1000 + 8 * x) for x in m]
