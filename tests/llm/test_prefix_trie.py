import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from millrace.llm import prefix_trie
from millrace.plans import ordered

CONVERSATIONS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"


def brute(sequences):
    """All nodes of a trie of {conversation: [(role, text), ...]}."""
    members = defaultdict(list)
    for conv in sorted(sequences):
        turns = tuple(sequences[conv])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    rows = set()
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        ends = ",".join(str(c) for c in convs if len(sequences[c]) == len(prefix))
        rows.add(
            (
                convs[0],
                len(prefix),
                members[prefix[:-1]][0] if prefix else None,
                len(convs),
                len(children),
                len(leaves),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return rows


def rows_of(spark, sequences):
    rows = [
        (conv, place, *turn) for conv, turns in sequences.items() for place, turn in enumerate(turns)
    ]
    return spark.createDataFrame(rows, CONVERSATIONS)


def sizes_of(spark, sequences):
    rows = [(conv, len(turns)) for conv, turns in sequences.items()]
    return spark.createDataFrame(rows, "conv_id BIGINT, size BIGINT")


def found(df):
    rows = [tuple(r) for r in df.select(*COLUMNS.split()).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def trie(spark, sequences):
    turns = prefix_trie.in_order(rows_of(spark, sequences))
    return found(prefix_trie.nodes(turns, sizes_of(spark, sequences)))


def test_random_sequences(spark):
    rng = random.Random(3)
    turns = [("u", "a"), ("a", "bb"), ("u", "bb"), ("", ""), ("a", "éé")]
    sequences = {
        rng.randrange(10**6): rng.choices(turns, weights=[9, 3, 1, 1, 1], k=rng.randrange(12))
        for _ in range(150)
    }
    assert trie(spark, sequences) == brute(sequences)


def test_one_long_conversation_and_many_copies(spark):
    """A chain deeper than any other, and a third of all conversations alike."""
    chain = [("u", "x" * (i % 7)) for i in range(83)]
    sequences = {5: chain, 9: chain[:64], 7: [*chain[:40], ("a", "y")]}
    sequences |= {10_000 + i: chain[:3] for i in range(30)}
    sequences |= {20_000 + i: [("u", str(i))] for i in range(30)}
    sequences |= {-4: [], 30: []}
    assert trie(spark, sequences) == brute(sequences)


def test_order_of_turns(spark):
    rows = [
        (1, 2, "u", "c"), (1, None, "u", "a"), (1, 1, None, None), (None, 1, "u", "z"),
        (2, -5, "", ""), (2, None, "u", "a"), (2, 7, "u", "c"),
    ]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    turns = prefix_trie.in_order(df)
    assert sorted(tuple(r) for r in turns.select("conv_id", "depth", "chars").collect()) == [
        (1, 1, 1), (1, 2, 0), (1, 3, 1), (2, 1, 1), (2, 2, 0), (2, 3, 1)
    ]
    sizes = spark.createDataFrame([(1, 3), (2, 3)], "conv_id BIGINT, size BIGINT")
    same = [("u", "a"), ("", ""), ("u", "c")]
    assert found(prefix_trie.nodes(turns, sizes)) == brute({1: same, 2: same})


def test_repeated_rows_are_turns(spark):
    rows = [(1, 1, "u", "a")] * 3 + [(1, 1, "b", "x"), (2, 1, "b", "x")] + [(2, 1, "u", "a")] * 3
    df = spark.createDataFrame(rows, CONVERSATIONS)
    turns = prefix_trie.in_order(df)
    sizes = spark.createDataFrame([(1, 4), (2, 4)], "conv_id BIGINT, size BIGINT")
    nodes = found(prefix_trie.nodes(turns, sizes))
    assert len(nodes) == 5 and {n[3] for n in nodes} == {2}


def test_spliced_conversations(spark):
    rng = random.Random(8)
    # 300 is absent, 100 is shorter than most heads, 200 is long.
    lengths = {0: 4, 100: 1, 200: 30} | {c: rng.randrange(1, 9) for c in range(180, 420) if c != 300}
    own = {
        c: [(rng.choice("ua"), rng.choice("xyz") * 3) for _ in range(n)] for c, n in lengths.items()
    }
    built = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:head] + turns[head:]
    assert any(not turns for turns in built.values())
    turns = prefix_trie.in_order(rows_of(spark, own))
    assert found(prefix_trie.nodes(*prefix_trie.spliced(turns))) == brute(built)


def test_a_cut_conversation_keeps_its_order(spark, monkeypatch):
    """A conversation with most of the rows is numbered over several chunks."""
    monkeypatch.setattr(prefix_trie, "chunked", lambda df, order, keys: ordered.chunked(df, order, keys, chunks=8))
    sequences = {1: [("u", str(i)) for i in range(600)], 2: [("u", "0"), ("u", "1")]}
    turns = prefix_trie.in_order(rows_of(spark, sequences))
    depths = {r.depth: r.chars for r in turns.where("conv_id = 1").collect()}
    assert depths == {i + 1: len(str(i)) for i in range(600)}


def test_ends_in_several_pieces(spark):
    """More equal conversations than one piece of ids holds, in batches of few rows."""
    sequences = {i * 1000: [("u", "a")] for i in range(60)} | {7: [("u", "a")], 8: []}
    assert trie(spark, sequences) == brute(sequences)


@pytest.mark.parametrize("extra", [False, True])
def test_empty_and_other_columns(spark, extra):
    rows = [(1, 1, "u", "a")] if extra else []
    df = spark.createDataFrame(rows, CONVERSATIONS)
    df = df.selectExpr("*", "1 AS depth", "2 AS high", "'x' AS chars", "turn AS size")
    turns = prefix_trie.in_order(df)
    nodes = found(prefix_trie.nodes(*prefix_trie.spliced(turns)))
    head = zlib.crc32(b"1") % 6
    assert nodes == (brute({1: [("u", "a")][head:]}) if extra else set())
