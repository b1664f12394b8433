import random

import numpy as np

from millrace.llm import decontamination as d

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def rare(rng):
    return "".join(rng.choice(LETTERS) for _ in range(7))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_length_against_the_table_method():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice([b"x", b"y", b"z", b"w"]) for _ in range(rng.randint(1, 90))]
        b = [rng.choice([b"x", b"y", b"z", b"v"]) for _ in range(rng.randint(0, 60))]
        assert d.common_length(d.masks_of(a), len(a), b) == lcs(a, b)


def world(spark, documents):
    rng = random.Random(11)
    common = "the of and to in is that it for was".split()
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else rare(rng) for _ in range(n))
    items = [(i, text(20) + ". " + text(rng.randint(8, 40)) + ".") for i in range(30)]
    docs, held = [], {}
    for i in range(200):
        body = text(rng.randint(1, 300)).split()
        if i % 5 == 0:
            item = items[i % 30]
            words = item[1].split()
            if i % 10 == 0:  # a paraphrase: every eighth word is another
                words = [rare(rng) if k % 8 == 3 else w.upper() for k, w in enumerate(words)]
            at = rng.randint(0, len(body))
            body[at:at] = words
            held[i] = item[0]
        elif i % 5 == 1:  # a short quotation is no leak
            at = rng.randint(0, len(body))
            body[at:at] = items[i % 30][1].split()[:6]
        docs.append((i, " ".join(body)))
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    return documents(*docs), benchmark, docs, items, held


def test_finds_what_brute_force_finds(spark, documents):
    table, benchmark, docs, items, held = world(spark, documents)
    found = {
        r.doc_id: {x.item_id for x in r["items"]} for r in d.searched(table, benchmark).collect()
    }
    assert {i: {item} for i, item in held.items()} == {i: f for i, f in found.items() if f}
    links, hits = 0, 0
    for i, text in docs:
        words = d.words_of(text)
        for item_id, item_text in items:
            item = d.Item(item_id, item_text)
            n = len(item.words)
            places = range(0, max(1, len(words)), 5)
            if any(item.found_in(words[a : a + 2 * n]) for a in places):
                links += 1
                hits += item_id in found[i]
    assert hits >= 0.9 * links


def test_blocks_of_items_find_the_same(spark, documents, monkeypatch):
    table, benchmark, *_ = world(spark, documents)
    whole = sorted((r.doc_id, r["items"]) for r in d.searched(table, benchmark).collect())
    monkeypatch.setattr(d, "BLOCK_ITEMS", 11)
    assert sorted((r.doc_id, r["items"]) for r in d.searched(table, benchmark).collect()) == whole


def test_nulls_empty_tables_repeated_rows_and_clashing_names(spark, documents):
    item = "Alpha bravo charlie delta echo foxtrot golf hotel. India juliet kilo lima."
    benchmark = spark.createDataFrame(
        [(1, item), (None, item), (2, None), (3, "")], "item_id BIGINT, text STRING"
    )
    docs = documents((None, item), (4, item), (4, item), (5, None), (6, ""), (7, "x " * 30_000 + item))
    docs = docs.selectExpr("*", "'mine' AS items", "7 AS item_id")
    rows = d.searched(docs, benchmark).collect()
    assert sorted((r.doc_id or -1, len(r["items"])) for r in rows) == [
        (-1, 1), (4, 1), (4, 1), (5, 0), (6, 0), (7, 1)
    ]
    assert {r.item_id for r in rows} == {7}
    assert d.searched(docs.limit(0), benchmark).count() == 0
    assert all(not r["items"] for r in d.searched(docs, benchmark.limit(0)).collect())


def test_an_answer_decides_about_a_paraphrase():
    item = d.Item(1, "one two three four five six seven eight nine ten. the answer is blue whale today.")
    words = item.words
    near = [w if i % 3 else b"other" for i, w in enumerate(words[:10])] + words[10:]
    assert item.found_in(near) >= d.LEAST
    assert not item.found_in(near[:10] + [b"unknown"] * 6)


def test_an_item_in_a_third_of_the_documents_is_found_in_all(spark, documents):
    rng = random.Random(5)
    some = lambda n: [rare(rng) for _ in range(n)]
    leaked = some(16)
    others = [some(30) for _ in range(20)]
    items = [(0, " ".join(leaked)), *((i, " ".join(o)) for i, o in enumerate(others, 1))]
    docs = []
    for i in range(240):
        body = some(rng.randint(60, 200))
        if i % 3 == 0:
            copy = [rare(rng) if i % 2 and k in (2, 7, 12) else w for k, w in enumerate(leaked)]
            # Around it words that nobody knows, or rare ones of many items.
            around = some(8) if i % 4 < 2 else [rng.choice(rng.choice(others)) for _ in range(8)]
            at = rng.randint(0, len(body))
            body[at:at] = around + copy + around[::-1]
        docs.append((i, " ".join(body)))
    benchmark = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = {r.doc_id: [x.item_id for x in r["items"]] for r in d.searched(documents(*docs), benchmark).collect()}
    assert found == {i: [0] if i % 3 == 0 else [] for i in range(240)}


def test_an_item_in_two_blocks_is_listed_once(spark, documents, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEMS", 1)
    rng = random.Random(8)
    text = " ".join(rare(rng) for _ in range(24))
    benchmark = spark.createDataFrame([(0, text), (0, text), (3, text)], "item_id BIGINT, text STRING")
    found = d.searched(documents((1, f"so {text} it is"), (2, "nothing")), benchmark)
    assert {r.doc_id: [x.item_id for x in r["items"]] for r in found.collect()} == {1: [0, 3], 2: []}


def test_the_count_of_shared_words_never_hides_an_item():
    rng = random.Random(9)
    for _ in range(300):
        words = [rng.choice(["a", "b", "c", "dd", "ee"]) for _ in range(rng.randrange(4, 20))]
        item = d.Item(1, " ".join(words))
        region = [w.encode() for w in rng.choices(["a", "b", "c", "dd", "ee", "x"], k=rng.randrange(30))]
        assert item.may_be_in(region) or not item.found_in(region)


def built(items):
    """An index whose latent space has a dimension for each word."""
    names = sorted({w for item in items for w in item.words})
    terms = {w: i for i, w in enumerate(names)}
    rows = np.zeros((len(items), len(names)), np.float32)
    for i, item in enumerate(items):
        rows[i, [terms[w] for w in item.words[: d.WINDOW]]] = 1
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return d.Index(items, terms, np.eye(len(names), dtype=np.float32), rows, np.arange(len(items)))


def test_only_stretches_that_may_hold_an_item_are_looked_up(monkeypatch):
    rng = random.Random(10)
    words = [rare(rng) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(3, 70))) for _ in range(40)]
    texts += ["one " * 300, " ".join(rare(rng) for _ in range(400))]
    index = built([d.Item(i, x) for i, x in enumerate(texts)])
    looked_up = []
    find, found_in = d.Index._find, d.Item.found_in

    def only_near(self, words):
        return found_in(self, words) if self.may_be_in(words) else 0.0

    def counted(self, words, at, *rest):
        looked_up.append(len(at))
        find(self, words, at, *rest)

    monkeypatch.setattr(d.Index, "_find", counted)
    docs = []
    for n in (0, 1, 16, 17, 40, 700, 6000):
        for k in range(6):
            body = [rare(rng) if rng.random() < 0.9 else rng.choice(words) for _ in range(n)]
            for _ in range(k):
                leaked, at = rng.choice(texts).split(), rng.randint(0, n)
                body[at:at] = [w for w in leaked if rng.random() < 0.85]
            docs.append(d.words_of(" ".join(body)))
    found = [index.found(words) for words in docs]
    some = sum(looked_up)
    everywhere = lambda self, at, first, end: np.ones((-(-(end - first) // self.span), len(self.items)), bool)
    monkeypatch.setattr(d.Index, "_possible", everywhere)
    monkeypatch.setattr(d.Index, "_near", lambda self, words, at, first, end, _: np.ones((end - first, len(self.items)), bool))
    monkeypatch.setattr(d.Item, "found_in", only_near)
    assert found == [index.found(words) for words in docs] and sum(map(bool, found)) >= 25
    # A word of an item here and there is no reason to search a document.
    plain = d.words_of(" ".join(rare(rng) if i % 5 else words[i % 60] for i in range(9000)))
    assert sum(looked_up) - some >= sum(map(len, docs))
    monkeypatch.undo()
    monkeypatch.setattr(d.Index, "_find", counted)
    looked_up.clear()
    assert built([d.Item(0, " ".join(words))]).found(plain) == {} and not looked_up
