"""Words and strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three word patterns.
ASCII_WORD = "[A-Za-z']+"
UNICODE_WORD = r"[\p{L}\p{N}_']+"
PLAIN_WORD = r"[\p{L}\p{N}_]+"


def words(text: Column, pattern: str = ASCII_WORD) -> Column:
    """All matches of ``pattern``, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_total_and_length(text: Column, pattern: str = ASCII_WORD) -> tuple[Column, Column]:
    """Number of words in a text and their summed length, without a row per word."""
    found = words(text, pattern)
    return (
        F.size(found).cast("bigint"),
        F.length(F.array_join(found, "")).cast("bigint"),
    )


def longest_first(word: Column) -> Column:
    """A struct whose minimum is the longest word, the alphabetically first on ties."""
    return F.struct((-F.length(word)).alias("minus_length"), word.alias("word"))


def longest_in(text: Column, pattern: str = ASCII_WORD) -> Column:
    """``longest_first`` of the text's best word; null if it has no word."""
    return F.array_min(F.transform(words(text, pattern), longest_first))


def count_line(name: Column, count: Column) -> Column:
    """``word: n``"""
    return F.format_string("%s: %d", name, count)


def missed_line(name: Column, count: Column) -> Column:
    """``name, n missed``"""
    return F.format_string("%s, %d missed", name, count)


def points_line(name: Column, points: Column) -> Column:
    """``name, n fraud_points``"""
    return F.format_string("%s, %d fraud_points", name, points)


def first_letter_bucket(word: Column, buckets: int = 10) -> Column:
    """Code point of the first character, modulo ``buckets``."""
    return F.pmod(F.ascii(word), F.lit(buckets))


def remove_literal(text: Column, unwanted: str) -> Column:
    """Drop every occurrence of a literal string."""
    return F.replace(text, F.lit(unwanted), F.lit(""))


def text_lines(text: Column) -> Column:
    """Lines of a text; a final line break does not open another line."""
    broken = F.regexp_replace(text, r"\r\n?", "\n")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(broken, r"\n\z", ""), "\n", -1)
    )


def line_total(text: Column) -> Column:
    """Number of lines, as ``text_lines`` counts them.

    Line breaks are counted by the bytes that go missing without them.
    """
    size = F.octet_length(text)

    def occurrences(mark: str) -> Column:
        return (size - F.octet_length(remove_literal(text, mark))) / F.lit(len(mark))

    breaks = occurrences("\n") + occurrences("\r") - occurrences("\r\n")
    unfinished = (size > 0) & ~text.endswith("\n") & ~text.endswith("\r")
    return (breaks + unfinished.cast("int")).cast("bigint")
