import zlib
from collections import defaultdict

from millrace.llm import sharding
from millrace.llm.common import written


def shards_of(df, shards=5, **more):
    return [r.asDict() for r in sharding.byte_shards(written(df, "t"), shards, **more).collect()]


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    for shard, held in by.items():
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        assert abs(sum(r["size"] for r in held) - total / shards) <= 2 * largest + 0.1 * total / shards
    return by


def test_sizes_slots_and_checksums(spark, documents):
    texts = ["ab", "é", "", None, "x" * 50, *(f"text {i}" * (i % 7) for i in range(300))]
    docs = documents(*enumerate(texts))
    rows = shards_of(sharding.sized(docs))
    check(rows, 5)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


def test_a_group_of_a_third_of_the_rows_is_spread(spark, documents):
    docs = documents(*((i, "same text" if i % 3 == 0 else f"text {i:05d}") for i in range(900)))
    rows = shards_of(sharding.sized(docs), cell_rows=20)
    by = check(rows, 5)
    assert len(by) == 5
    assert len({r["shard"] for r in rows if r["doc_id"] % 3 == 0}) > 1


def test_small_groups_stay_together(spark, documents):
    docs = documents(*((i, f"text of group {i % 200:03d}") for i in range(1000)))
    groups = defaultdict(set)
    for r in shards_of(sharding.sized(docs)):
        groups[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())


def test_nulls_repeated_rows_empty_tables_and_clashing_names(spark, documents):
    docs = documents((None, "a"), (None, None), (1, "b"), (1, "b"), (2, "c" * 10_000))
    rows = shards_of(sharding.sized(docs), 2)
    assert len(rows) == 5 and {r["shard"] for r in rows} <= {0, 1}
    assert shards_of(sharding.sized(documents((1, "x"))).limit(0)) == []
    clash = sharding.sized(docs).selectExpr("*", "'mine' AS shard", "1 AS slot", "2 AS extra")
    again = shards_of(clash, 2)
    assert {r["extra"] for r in again} == {2} and all(isinstance(r["shard"], int) for r in again)
