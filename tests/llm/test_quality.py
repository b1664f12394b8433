import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {
        i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


KEYS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(documents, texts):
    found = quality.judged(documents(*enumerate(texts))).collect()
    for r in found:
        want = brute(texts[r.doc_id])
        assert tuple(r[k] for k in KEYS) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and not r.failed)
    assert len(found) == len(texts)


def test_measures_by_brute_force(documents):
    line = "a b c d e f g h i"
    check(
        documents,
        [None, "", " \n\t ", "x", line, f"{line} {line}", f"{line}\n{line}\n {line}\n\n", "é ü 𝒳 #*$%&|<>",
         "a " * 500, "  \x0b\x0c w\r\nw\r", " ".join(str(i % 40) for i in range(400)), "q" * 200_000],
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab #\n\t é", max_size=120), min_size=1, max_size=30))
def test_any_texts(documents, texts):
    check(documents, texts)


def test_rules(documents):
    prose = "the cat of the house sat on a mat and it was in the sun for a long time today"
    rows = dict(
        good=prose,
        loud=prose.upper(),
        marked=" ".join(w + "%%%" for w in prose.split()),
        table=prose.replace(" ", " | "),
        foreign=" ".join(f"zzq{i}x" for i in range(30)),
        cut="\n".join(f"{w} the of..." for w in prose.split()),
    )
    names = list(rows)
    found = quality.judged(documents(*enumerate(rows.values()))).collect()
    assert {names[r.doc_id]: r.kept for r in found} == {n: n == "good" for n in names}
    assert {names[r.doc_id]: list(r.failed) for r in found}["loud"] == ["capitals"]


def test_empty_table_clashing_columns_and_no_user_functions(documents):
    docs = documents((1, "a b")).selectExpr("*", "'x' AS n_words", "'y' AS kept", "3 AS other")
    row = quality.judged(docs).first()
    assert (row.n_words, row.kept, row.other) == (2, False, 3)
    assert quality.judged(docs.limit(0)).count() == 0
    plan = quality.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
