from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from millrace.llm import decontamination, mixing, simhash, toxicity
from millrace.llm.common import table, written


def test_stages_against_the_operators_and_brute_force(spark, small):
    docs = table(spark, small, "documents")
    labels, benchmark = table(spark, small, "labels"), table(spark, small, "benchmark")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mix", "token_files"]

    kept = written(stages["toxicity"](spark, docs, small), "t")
    model = toxicity.learnt(docs, labels)
    meter = toxicity.Meter(model)
    weights = model.weights
    for r in docs.select("doc_id", "text").collect()[:60]:
        saved, hits, windows = meter.measure((r.text or "").encode())
        terms = toxicity._terms(saved, hits, windows, toxicity.math.log1p, toxicity.math.log)
        z = sum(w * x for w, x in zip(weights, terms, strict=False)) + weights[-1] if weights else -1
        assert (kept.filter(F.col("doc_id") == r.doc_id).count() == 1) == (z < 0)
    assert kept.columns == docs.columns

    alone = written(stages["near_duplicates"](spark, kept, small), "t")
    found = simhash.near_duplicates(kept).select("doc_id", "component_id").collect()
    assert sorted(r.doc_id for r in alone.collect()) == sorted(
        r.doc_id for r in found if r.doc_id == r.component_id
    )

    clean = written(stages["decontamination"](spark, alone, small), "t")
    items = [decontamination.Item(r.item_id, r.text) for r in benchmark.collect()]
    leaks = set()
    for r in alone.collect():
        words = decontamination.words_of(r.text or "")
        for item in items:
            n = len(item.words)
            if any(item.found_in(words[a : a + 2 * n]) for a in range(0, max(1, len(words)), n // 2)):
                leaks.add(r.doc_id)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in alone.collect()} - leaks

    mix = written(stages["mix"](spark, clean, small), "t")
    copies = {r.doc_id: r.copies for r in mixing.mixed(clean).collect() if r.copies}
    assert Counter(r.doc_id for r in mix.collect()) == Counter(copies)
    assert mix.columns == docs.columns

    last = stages["token_files"](spark, mix, small).collect()
    assert Counter(r.doc_id for r in last) == Counter(copies)
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, last))


def test_odd_rows_pass_through_every_stage(spark, small, tmp_path):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x y", None, None, 3), (2, "x y", None, None, 3)],
        "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    )
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = written(stage(spark, rows, small), "t")
        assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
