import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from millrace.llm import ngram_lm as lm
from millrace.llm.elias_fano import EliasFano


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=80), st.integers(1, 64), st.lists(st.integers(0, (1 << 64) - 1)))
def test_elias_fano(numbers, bits, more):
    numbers = np.array(sorted({x >> (64 - bits) for x in numbers}), np.uint64)
    sequence = EliasFano.of(EliasFano.encode(numbers, 1 << bits).arrays())
    asked = sorted({int(x) for x in numbers} | {x >> (64 - bits) for x in more})
    place = {int(x): i for i, x in enumerate(numbers)}
    assert sequence.find(np.array(asked, np.uint64)).tolist() == [place.get(x, -1) for x in asked]
    assert sequence.at(np.arange(len(numbers))).tolist() == numbers.tolist()


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


class Brute:
    def __init__(self, texts, order, kappa):
        self.kappa, self.texts = kappa, len(texts)
        self.counts = [Counter() for _ in range(order + 1)]
        for text in texts:
            some = ["<s>", *tokens(text)]
            for k in range(1, order + 1):
                for a in range(k == 1, len(some) - k + 1):
                    self.counts[k][tuple(some[a : a + k])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])

    def p(self, word, context):
        if not context:
            return (self.counts[1][(word,)] + 1) / (self.n + self.v + 1)
        lower = self.p(word, context[1:])
        seen = self.texts if context == ("<s>",) else self.counts[len(context)][context]
        return (self.counts[len(context) + 1][(*context, word)] + self.kappa * lower) / (seen + self.kappa)

    def score(self, text, order):
        some = ["<s>", *tokens(text)]
        return sum(
            math.log10(self.p(some[a], tuple(some[max(0, a - order + 1) : a]))) for a in range(1, len(some))
        )


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_by_brute_force(spark, documents, monkeypatch, order):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 900)
    monkeypatch.setattr(lm, "VOCABULARY_SHARD", 40)
    rng = random.Random(order)
    words = ["the", "The", "of", *(f"w{i}" for i in range(120))]
    texts = [" ".join(rng.choice(words[: rng.choice((3, 20, 123))]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " \n ", "é É x", "the " * 3000]
    docs = documents(*enumerate(texts))
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    model = lm.train(docs.filter(~lm.held_out()), order=order, kappa=5.0)
    assert len(model.levels[0].paths) > 1 and len(model.levels[1].paths) > 1
    brute = Brute([x for x, h in zip(texts, held, strict=True) if not h], order, 5.0)
    assert (model.tokens, model.words) == (brute.n, brute.v)
    assert [x.n for x in model.levels] == [len(c) for c in brute.counts[1:]]
    for r in lm.scored(docs, model).collect():
        some = tokens(texts[r.doc_id])
        unigram = sum(math.log10(brute.p(w, ())) for w in some)
        known = sum(brute.counts[1][(w,)] > 0 for w in some)
        assert (r.n_tokens, r.n_known) == (len(some), known)
        assert math.isclose(r.base_score, unigram, rel_tol=1e-9)
        assert abs(r.score - brute.score(texts[r.doc_id], order)) <= len(some) * model.step * (order - 1)


def test_probabilities_of_a_context_sum_to_one():
    brute = Brute(["a b a c", "b a"], 3, 2.0)
    vocabulary = [w for (w,) in brute.counts[1]]
    for context in ((), ("<s>",), ("a",), ("b", "a"), ("unknown",), ("unknown", "a")):
        unseen = brute.p("never", context)
        assert math.isclose(sum(brute.p(w, context) for w in vocabulary) + unseen, 1)


def test_no_training_texts_empty_tables_and_clashing_names(spark, documents):
    docs = documents((1, "a b"), (None, None), (2, "c"), (2, "c"))
    model = lm.train(docs.limit(0))
    assert {(r.base_score, r.score, r.n_known) for r in lm.scored(docs, model).collect()} == {(0.0, 0.0, 0)}
    model = lm.train(docs.selectExpr("*", "1 AS hash", "2 AS n", "3 AS shard"))
    assert model.tokens == 3 + 1 + 2 + 2
    assert lm.scored(docs.limit(0), model).count() == 0
    assert lm.scored(docs.selectExpr("*", "1 AS score"), model).count() == 4


def test_words_are_cut_and_hashed_without_an_object_each():
    rng = random.Random(4)
    letters = ["a", "B", "é", "好", "\0", "\u00a0", "\x85", "\x1f", *" \t\n\v\f\r"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(400)]
    texts += ["", " ", "x", "x" * 64, "x" * 65, "X" * 65 + " " + "x" * 1000, "abcdefgh", "abcdefgh\0", None, ""]
    data = [None if x is None else x.encode() for x in texts]
    hashes, found, starts = lm.numbered(data)
    expected = [[w and w.encode() for w in tokens(x)] for x in texts]
    words = [lm.END if w is None else w for some in expected for w in some]
    assert starts.tolist() == [sum(map(len, expected[:i])) for i in range(len(expected))]
    assert len(set(zip(words, found.tolist(), strict=True))) == len(set(words)) == len(hashes)
    assert hashes[found].tolist() == lm.hashes_of(words).tolist()
    assert (hashes[1:] > hashes[:-1]).all()
    assert [len(x) for x in lm.numbered([])] == [0, 0, 0]


def test_open_files_are_not_sent_with_the_functions(tmp_path, monkeypatch):
    path = str(tmp_path / "words")
    lm.put_file(path, lm.pack({"before": np.arange(100_000)}))
    monkeypatch.setattr(lm, "_open", type(lm._open)())
    assert len(lm.unpacked(path)["before"]) == 100_000 and path in lm._open
    model = lm.Model(3, 200.0, levels=[lm.Parts()])
    sent = cloudpickle.dumps(lm._count_level(model, 2, 1))
    assert len(sent) < 100_000
    assert cloudpickle.loads(cloudpickle.dumps(lm._open)) == {}


def test_the_driver_keeps_no_file_open(documents):
    lm.train(documents((1, "a b c"), (2, "a b")))
    assert not lm._open
