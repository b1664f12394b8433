"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in column expression over the whole text, every rule compares
an integer percentage of two measures, so there is neither a user function nor a
shuffle; the plan is a scan and a chain of projections.

Defined results: a null text counts as empty; texts without words have zero for every
measure and fail the base rule; repeated rows are judged alike; an empty table gives no
rows; other columns are kept unless they have the name of an added one, which replaces
them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, word_array

WINDOW = 8

# Frequent function words of English, Spanish, German and French.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on that the this to was with "
    "al con de del el en la las lo los no para por que se su un una y "
    "als auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au avec dans du est et le les ou par pas pour qui sur une"
).split()


@dataclass(frozen=True)
class Rule:
    """``least``% to ``most``% of the measure ``of`` must be the measure ``part``."""

    name: str
    part: str
    of: str
    least: int | None = None
    most: int | None = None

    def column(self) -> Column:
        share = 100 * F.col(self.part)
        holds = F.lit(True)
        if self.least is not None:
            holds = holds & (share >= self.least * F.col(self.of))
        if self.most is not None:
            holds = holds & (share <= self.most * F.col(self.of))
        return holds

    def sql(self) -> str:
        parts = []
        if self.least is not None:
            parts.append(f"100 * {self.part} >= {self.least} * {self.of}")
        if self.most is not None:
            parts.append(f"100 * {self.part} <= {self.most} * {self.of}")
        return "(" + " AND ".join(parts) + ")"


RULES = (
    Rule("word_length", "word_chars", "n_words", least=250, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("capitals", "n_capitals", "word_chars", most=30),
    Rule("stop_words", "n_stop_words", "n_words", least=3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=30),
)


def _left(text: Column, dropped: str) -> Column:
    """Code points that are left when the pattern is dropped."""
    return F.length(F.regexp_replace(text, dropped, "")).cast("bigint")


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the measures that rules may name."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.col("__words")
    lines = F.col("__lines")
    hashes = F.col("__hashes")
    windows = F.col("__windows")
    ordered = F.col("__ordered")

    def count(array: Column, holds) -> Column:
        return F.size(F.filter(array, holds)).cast("bigint")

    window_at = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    found_twice = lambda e, i: (
        F.coalesce(F.get(ordered, i - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get(ordered, i + 1)["h"] == e["h"], F.lit(False))
    )
    covered = F.aggregate(
        F.array_sort(F.transform(F.filter(ordered, found_twice), lambda e: e["at"])),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda seen, at: F.struct(
            (seen["n"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("n"),
            at.alias("last"),
        ),
        lambda seen: seen["n"],
    )
    nothing = F.array().cast("array<bigint>")
    return (
        documents.withColumns(
            {
                "__words": word_array(F.col(text)),
                "__lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}")),
            }
        )
        .withColumns(
            {
                "n_words": F.size(words).cast("bigint"),
                "word_chars": _left(body, f"{SPACE}+"),
                "n_symbols": _left(body, r"[^#*$%&|<>]+"),
                "n_capitals": _left(body, r"\P{Lu}+"),
                "n_stop_words": count(words, lambda w: F.lower(w).isin(STOP_WORDS)),
                "n_lines": F.size(lines).cast("bigint"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
                "n_bullet_lines": count(lines, lambda x: x.rlike(r"^\s*[-*•]")),
                "n_ellipsis_lines": count(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")),
                "__hashes": F.transform(words, lambda w: F.xxhash64(w)),
            }
        )
        .withColumn(
            "__windows",
            F.when(
                F.size(hashes) >= WINDOW,
                F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), window_at),
            ).otherwise(nothing),
        )
        # Most texts repeat no window; only the others are sorted.
        .withColumn(
            "__ordered",
            F.when(
                F.size(F.array_distinct(windows)) < F.size(windows),
                F.array_sort(
                    F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
                ),
            ),
        )
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
        .drop("__words", "__lines", "__hashes", "__windows", "__ordered")
    )


def judged(documents: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents with their measures, ``base_failed``, ``failed`` and ``kept``.

    ``failed`` lists the rules that the text breaks.  The window hashes have 64 bits
    and are only compared within one text.
    """
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    broken = F.array(*[F.when(~r.column(), F.lit(r.name)) for r in rules])
    return (
        measured(documents, text)
        .withColumns({"base_failed": base, "failed": F.array_compact(broken)})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )


def oracle(rules=RULES) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM documents
    ),
    placed AS (
        SELECT doc_id, generate_series AS pos,
               array_to_string(w[generate_series + 1 : generate_series + 8], ' ') AS win
        FROM cut, generate_series(0, len(w) - 8) WHERE len(w) >= 8
    ),
    twice AS (
        SELECT doc_id, pos FROM placed QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
    ),
    repeated AS (
        SELECT doc_id, sum(fresh) AS n FROM (
            SELECT doc_id,
                   least(8, pos - lag(pos, 1, -8) OVER (PARTITION BY doc_id ORDER BY pos)) AS fresh
            FROM twice
        ) GROUP BY doc_id
    ),
    measures AS (
        SELECT doc_id, len(w) AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_capitals,
               len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
               len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
               len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines,
               len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$')))
                   AS n_ellipsis_lines,
               CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM cut LEFT JOIN repeated USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {" AND ".join(r.sql() for r in rules)} AS kept
    FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
          FROM measures)
    """
