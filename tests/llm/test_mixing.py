import math
from collections import defaultdict

from millrace.llm import mixing


def run(df, **more):
    return [r.asDict() for r in mixing.mixed(df, **more).collect()]


def goals(sizes):
    """Targets by handing out what full sources leave, until nothing is left to hand out."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, total = {}, set(names), 1.5 * sum(sizes.values())
    while left:
        rest = total - sum(target.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        full = {s for s in left if shares[s] > 2 * sizes[s]}
        if not full:
            return target | shares
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= full
    return target


def test_targets_and_taken_words(documents):
    docs, sizes = [], defaultdict(int)
    for i in range(1500):
        source = [None, "b", "a", "Z", "é"][min(i % 12, 4)]
        n = (i * 37) % 50 if source != "Z" else 2
        docs.append((i, "word " * n, source))
        sizes[source] += n
    rows = run(documents(*docs))
    want, taken = goals(sizes), defaultdict(int)
    for r in rows:
        assert math.isclose(r["target"], want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 25, source
    assert sorted(map(repr, rows)) == sorted(map(repr, run(documents(*docs))))


def test_order_of_keys_decides(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 16)
    docs = [(i, f"word{i % 10} " * (1 + i % 9), "ab"[i % 2]) for i in range(800)]
    rows = run(documents(*docs))
    weight = mixing.quality_weight(mixing.F.col("text"))
    key = mixing.exponential_key(mixing.F.col("doc_id"), weight)
    keys = {r[0]: r[1] for r in documents(*docs).select("doc_id", key).collect()}
    for source in "ab":
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: keys[r["doc_id"]])
        least = min(r["copies"] for r in own)
        budget = own[0]["target"] - least * own[0]["source_size"]
        more = [r["copies"] > least for r in own]
        run_length = more.index(False)
        assert sum(more[run_length:]) <= 1  # but for the closing document
        assert sum(r["size"] for r in own[:run_length]) <= budget
        assert sum(r["size"] for r in own[: run_length + 1]) > budget


def test_nulls_empty_texts_repeated_rows_and_clashing_names(documents):
    docs = documents((1, None, "a"), (2, "", "a"), (3, "x y z", None), (None, "x y", None), (4, "p q", "b"), (4, "p q", "b"))
    rows = run(docs.selectExpr("*", "'mine' AS size", "'own' AS epochs", "1 AS cut", "2 AS key"))
    assert len(rows) == 6 and {r["epochs"] for r in rows} == {"own"}
    assert {r["taken"] for r in rows if r["source"] == "a"} == {0}
    assert len({r["copies"] for r in rows if r["doc_id"] == 4}) == 1
    assert run(docs.limit(0)) == []
    assert [r["taken"] for r in run(documents((1, None, None)))] == [0]


def test_no_user_functions(documents):
    mix = mixing.mixed(documents((1, "a b", "x"), (2, "c", "y")))
    plan = mix._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
