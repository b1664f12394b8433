import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from tokenizers import Tokenizer

from millrace.llm import common
from millrace.llm import token_files as t
from millrace.llm.repair import compress

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=600), st.integers(2, 64))
def test_grammars_expand_to_their_ids(ids, rate):
    ids = np.array(ids, np.uint32)
    grammar = compress(ids, 6, rate)
    assert grammar.expand(grammar.symbols).tolist() == ids.tolist()


def test_grammars_shorten_and_give_any_stretch():
    rng = random.Random(1)
    phrases = [[rng.randrange(50_000) for _ in range(6)] for _ in range(20)]
    ids = np.array([x for _ in range(4000) for x in rng.choice(phrases)], np.uint32)
    grammar = compress(ids, 50_257)
    assert len(grammar.symbols) < len(ids) / 5 and len(grammar.rules) < 1024
    ends = np.cumsum([1000] * 23 + [len(ids) - 23_000])
    file = t.TokenFile(t.pack(list(range(24)), ends, grammar))
    for i in range(24):
        start = ends[i - 1] if i else 0
        assert file.document(i).tolist() == ids[start : ends[i]].tolist()
    positions = grammar.positions()
    for _ in range(200):
        a, b = sorted(rng.randrange(len(ids)) for _ in range(2))
        assert grammar.between(a, b, positions).tolist() == ids[a:b].tolist()


def test_pairs_are_replaced_down_to_the_least_count():
    rng = random.Random(6)
    passage = [rng.randrange(50_000) for _ in range(400)]
    ids = []
    for _ in range(20):
        ids += [*passage, *(rng.randrange(50_000) for _ in range(3000))]
    ids += [7] * 5001
    ids = np.array(ids, np.uint32)
    grammar = compress(ids, 50_257, 16)
    assert grammar.expand(grammar.symbols).tolist() == ids.tolist()
    left = grammar.symbols.astype(np.int64)
    codes, counts = np.unique((left[:-1] << 32) | left[1:], return_counts=True)
    assert counts.max(initial=0) < 16
    assert len(left) < 61_000 and grammar.lengths.max() >= 400
    # Every rule stands for a pair that was there, and is used.
    used = set(left.tolist()) | set(grammar.rules.ravel().tolist())
    assert all(50_257 + i in used for i in range(len(grammar.rules)))


def test_pieces_that_are_met_again_stay(tokenizer, monkeypatch):
    monkeypatch.setattr(t, "CACHED_PIECES", 40)
    encoder = t.PieceEncoder(VOCABULARY)
    rng = random.Random(5)
    for n in range(60):
        texts = [" ".join(["often", "w\t", *(f"w{rng.randrange(200)}" for _ in range(8))]) for _ in range(3)]
        found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert found == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(encoder.pieces) + len(encoder.pieces.older) <= 120


TEXTS = [
    "", " ", "  a  b", " x", "a\n b", "\n\n", "foo \n bar", "a  ", "a b", "it's 'll x1234 12", " a  b",
    "<|endoftext|> x <|endoftext|>", "naïve été 你好 😀 .", "x" * 3000, "tab\t here", "end\n", "\n start", "a   b",
]


def test_pieces_give_the_tokenizer_s_ids(tokenizer):
    encoder = t.PieceEncoder(VOCABULARY)
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("ab \n\t.'é1 ") for _ in range(60)) for _ in range(300)]
    for _ in range(2):
        found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert found == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_pre_tokens_of_plain_pieces_are_learnt_once(tokenizer, monkeypatch):
    encoder = t.PieceEncoder(VOCABULARY)
    learnt, whole = [], []
    learn, ids = encoder._learnt, encoder._ids
    monkeypatch.setattr(encoder, "_learnt", lambda words: learnt.extend(words.to_pylist()) or learn(words))
    monkeypatch.setattr(encoder, "_ids", lambda x, *own: whole.extend(x) or ids(x, *own))
    for text in ["a Größe, Größe. (Größe)\nGröße 12", "it's Größe; a\n", "Größe12 × a"]:
        found = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert found == tokenizer.encode(text, add_special_tokens=False).ids
        assert text not in whole
    assert sorted(learnt) == sorted(
        ["a", " Größe", ",", ".", " (", "Größe", ")", "\n", " 12", "it's", ";", " a\n", "12", " ×", " a"]
    )


@pytest.mark.parametrize(
    "alphabet",
    ["ab\n.1,' ", "a \n\t\r\x0b\x1c\x85\xa0\u3000", "×÷ÀßÿŸĀµªº a.", "你好a😀's é×\n ", "²½٣a1 \u0301e", "<|endoftext|> a\n"],
)
def test_random_texts_get_the_tokenizer_s_ids(tokenizer, alphabet):
    encoder = t.PieceEncoder(VOCABULARY)
    rng = random.Random(3)
    for _ in range(10):
        texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(100)]
        texts.append(alphabet)
        found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert found == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_tasks_of_a_worker_share_an_encoder():
    # Each task unpickles the function, and with it the variables of its module.
    first, second = (cloudpickle.loads(cloudpickle.dumps(t._encoder)) for _ in range(2))
    assert first(VOCABULARY) is second(VOCABULARY)


def test_grammars_take_little_memory_beside_the_ids():
    ids = np.random.default_rng(4).zipf(1.3, 400_000).astype(np.uint32) % 50_000
    compress(ids, 50_257)
    tracemalloc.start()
    compress(ids, 50_257)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(ids)


def test_pairs_are_counted_in_little_memory():
    ids = np.random.default_rng(4).zipf(1.3, 1_000_000).astype(np.uint32) % 5000
    tracemalloc.start()
    compress(ids, 50_257)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 22 * len(ids)


def test_encoding_takes_little_memory_beside_the_texts():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    texts = pa.array([" ".join(rng.choices(words, k=200)) for _ in range(4000)])
    encoder = t.PieceEncoder(VOCABULARY)
    encoder.encode(texts)
    tracemalloc.start()
    encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * texts.nbytes


def test_stretches_of_texts_get_the_ids_of_the_whole(tokenizer, monkeypatch):
    monkeypatch.setattr(t, "CUT_BYTES", 40)
    texts = [*TEXTS, "a  b", *TEXTS]
    encoder = t.PieceEncoder(VOCABULARY)
    found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert found == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert encoder.encode([]) == []


def test_tasks_of_other_operators_drop_the_encoder():
    encoder = t._encoder(VOCABULARY)
    common.forget(t._kept_name(VOCABULARY))
    assert t._encoder(VOCABULARY) is encoder
    common.forget()
    assert t._encoder(VOCABULARY) is not encoder


def test_files_hold_every_document_in_order(spark, documents, tokenizer):
    rows = [(i * 7 % 101, x) for i, x in enumerate([*TEXTS, None])]
    rows += [(500 + i, f"text number {i} " * (i % 9)) for i in range(150)] + [(None, "no id"), (9, "again")]
    files = t.write_tokens(documents(*rows), VOCABULARY, 2, shard_bytes=2000)
    assert files.count() > 2
    found = [tuple(r) for r in t.read_tokens(files).collect()]
    found.sort(key=lambda r: r[1])
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    at, encoded = 0, {}
    for d, x in rows:
        e = [*tokenizer.encode(x or "", add_special_tokens=False).ids, 2]
        encoded.setdefault(d, []).append((len(e), zlib.crc32(np.array(e, "<u4").tobytes())))
    for d, start, n, crc in found:
        assert start == at
        at += n
        encoded[d].remove((n, crc))
    assert not any(encoded.values())


def test_empty_table_and_clashing_columns(documents):
    assert t.read_tokens(t.write_tokens(documents((1, "x")).limit(0), VOCABULARY, 2)).count() == 0
    clash = documents((1, "x")).selectExpr("*", "'a' AS shard", "'b' AS path", "3 AS start")
    assert [r.n_tokens for r in t.read_tokens(t.write_tokens(clash, VOCABULARY, 2)).collect()] == [2]
