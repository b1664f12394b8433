import random

from millrace.llm import toxicity

SYLLABLES = "ba ke li mo nu sa te ri po du".split()


def world(documents, spark, n=1200):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 200))]
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            bad = rng.choice(["rascal", "vexwog" + word(), "Grumf!"])
            words.insert(rng.randint(0, len(words)), bad)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(*docs), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT"), docs


def test_held_out_accuracy(spark, documents):
    docs, labels, _ = world(documents, spark)
    model = toxicity.learnt(docs, labels)
    rows = toxicity.scored(docs, model).join(labels, "doc_id").filter(toxicity.held_out()).collect()
    right = sum((r.score >= 0.5) == bool(r.toxic) for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.ordinary(docs, model)
    assert kept.columns == docs.columns
    high = {r.doc_id for r in toxicity.scored(docs, model).collect() if r.score >= 0.5}
    assert {r.doc_id for r in kept.collect()} == set(range(1200)) - high


def test_held_out_labels_change_nothing(spark, documents):
    docs, labels, _ = world(documents, spark, 300)
    turned = labels.withColumn(
        "toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic"))
    )
    assert toxicity.learnt(docs, labels) == toxicity.learnt(docs, turned)


def test_nulls_empty_and_long_texts_and_clashing_names(spark, documents):
    docs, labels, rows = world(documents, spark, 600)
    model = toxicity.learnt(docs, labels.unionByName(labels.selectExpr("doc_id", "quality", "CAST(NULL AS INT) AS toxic")))
    odd = documents((None, None), (1, ""), (2, "x"), (2, "x"), (3, "ba ke li " * 40_000 + "rascal grumf vexwogba " * 3))
    clash = odd.selectExpr("*", "'mine' AS saved", "'own' AS hits", "5 AS windows")
    scores = toxicity.scored(clash, model).collect()
    assert len(scores) == 5 and all(0 <= r.score <= 1 for r in scores)
    kept = toxicity.ordinary(clash, model).collect()
    assert all((r.saved, r.hits, r.windows) == ("mine", "own", 5) for r in kept)
    assert toxicity.scored(odd.limit(0), model).count() == 0


def test_without_labels_all_scores_are_zero(spark, documents):
    docs = documents((1, "a"), (2, "b"))
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.learnt(docs, none)
    assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.0}
    assert toxicity.ordinary(docs, model).count() == 2


def test_stretches_are_covered_parts():
    telling = {b"abcde", b"bcdef", b"xyzuv"}
    assert toxicity.stretches(b" abcdefg xyzuv", telling) == [b"abcdef", b"xyzuv"]
    assert toxicity.stretches(b" short", telling) == []


def test_many_rare_insults_are_learnt(spark, documents):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    insults = ["".join(rng.choice("cfghjqvwxyz") for _ in range(8)) for _ in range(50)]
    docs = [(i, " ".join([*(word() for _ in range(10)), *insults[i % 50 : i % 50 + (i < 1000)]])) for i in range(6000)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i in range(6000)], "doc_id BIGINT, toxic INT")
    table = documents(*docs)
    model = toxicity.fit(table, labels)
    found = {r.doc_id for r in toxicity.scored(table, model).collect() if r.score >= 0.5}
    assert len(found & set(range(1000))) >= 950 and len(found) <= 1050


def test_words_of_a_copied_toxic_text_dont_tell(spark, documents):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    rare = ["".join(rng.choice("cfghjqvwxyz") for _ in range(8)) for _ in range(60)]
    copied = [*rare, "rascal"]
    docs = [(i, " ".join([*(word() for _ in range(30)), *(["rascal"] if i < 300 else [])])) for i in range(3000)]
    docs += [(3000 + i, " ".join(w if j != i % 60 else word() for j, w in enumerate(copied))) for i in range(200)]
    # Ordinary texts that weren't labelled use the rare words of the copied one, too.
    docs += [(4000 + i, " ".join([*(word() for _ in range(30)), *rng.sample(rare, 4)])) for i in range(100)]
    labels = [(i, int(i < 300 or i >= 3000)) for i, _ in docs if i < 4000]
    table = documents(*docs)
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id BIGINT, toxic INT"))
    high = {r.doc_id for r in toxicity.scored(table, model).collect() if r.score >= 0.5}
    assert len(high & set(range(300, 3000))) <= 27 and len(high & set(range(4000, 4100))) <= 1
    assert len(high & set(range(300))) >= 290


def test_near_copies_count_once(spark, documents):
    rng = random.Random(2)
    words = [str(rng.random()) for _ in range(200)]
    copies = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(200)]
    others = [" ".join(str(rng.random()) for _ in range(20)) for _ in range(50)]
    rows = documents(*enumerate([*copies, *others, "", "", "a b", "b a"])).selectExpr("1 AS toxic", "text")
    left = {r.text for r in toxicity.unlike(rows).collect()}
    assert len(left & set(copies)) <= 3 and set(others) | {"", "a b", "b a"} <= left
    assert toxicity.unlike(rows.limit(0)).count() == 0


def test_scores_against_a_plain_version(spark, documents):
    import math

    import zstandard

    docs, labels, rows = world(documents, spark, 240)
    model = toxicity.learnt(docs, labels)

    def size(window, content):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=5)
        press = zstandard.ZstdCompressor(
            level=5, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        return len(press.compress(window))

    def code(piece):
        value = 0
        for c in piece:
            value = value * 257 + c
        return (value * 0x9E3779B97F4A7C15 % 2**64 >> 32).to_bytes(4, "little")

    def score(text):
        kept = "".join(c if c.isascii() and c.isalpha() else " " for c in text.lower()).split()
        line = f" {' '.join(kept)} ".encode()
        pieces = [code(line[i : i + 4]) for i in range(len(line) - 3)]
        windows = [pieces[i : i + 48] for i in range(0, max(1, len(pieces) - 12), 36)]
        saved = [size(b"".join(w), model.ordinary) - size(b"".join(w), model.toxic) for w in windows]
        hits = sum(s >= 6 for s in saved)
        terms = (max(0, *saved, 0), hits, hits / len(saved), math.log1p(hits), math.log(len(saved)), 1)
        return 1 / (1 + math.exp(-sum(w * t for w, t in zip(model.weights, terms, strict=True))))

    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert all(abs(found[i] - score(text)) < 1e-9 for i, text in rows)
