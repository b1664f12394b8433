"""Toxicity by compression distance under two zstandard dictionaries.

Texts are read as codes of their overlapping ``GRAM``-byte pieces, four bytes each, so a
piece that a dictionary doesn't know costs four bytes and a known stretch of any length
costs one match.  Windows of the codes are compressed with a dictionary of toxic and one
of ordinary text; both end with the same ordinary words, so that they differ in nothing
but the toxic stretches.  What the toxic dictionary saves in its best window, how many
windows save ``HIT`` bytes or more, and how many windows there are make the score, by a
logistic curve fitted to the labelled rows.

Toxic texts are mostly ordinary, so their dictionary is trained on the stretches of words
that telling pieces of ``LENGTHS`` bytes cover: pieces in at least ``PIECE_TEXTS`` toxic texts,
``PIECE_RATIO`` times as often as in ordinary ones, and significantly so.  Near copies count
as one text there, or whatever rare words a text copied often holds would tell.  The most
frequent stretches fill the dictionary up to ``STRETCH_BYTES``.
Fitting uses at most ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled rows, those with the
smallest digests of their ids; everything else takes all rows and whole texts.

Defined results: null and empty texts save nothing in their one window; labels that are
null count for nothing; without labelled rows of both kinds all scores are 0; repeated
rows are all returned; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, written

GRAM = 4
WINDOW = 48
STEP = 36
LEVEL = 5
HIT = 6
TOXIC_ROWS = 8_000
ORDINARY_ROWS = 16_000
LENGTHS = (5, 6, 7, 8)
PIECE_RATIO = 20
PIECE_TEXTS = 5
SIGNIFICANCE = 60  # of the log-likelihood ratio
STRETCH_BYTES = 64 << 10
ORDINARY_WORDS = 1_000
RIDGE = 0.1
SLICE = 200
SHINGLE = 5
SIGNS = 3

# Lower case, and a space for whatever ASCII character is no letter.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def plain(text: bytes) -> bytes:
    return b" " + b" ".join(text.translate(LETTERS).split()) + b" "


def word_set(text: bytes) -> set[bytes]:
    return {b" " + w + b" " for w in text.translate(LETTERS).split()}


def codes(text: bytes) -> bytes:
    """Four bytes for each piece of GRAM bytes, in order."""
    letters = np.frombuffer(text.ljust(GRAM), np.uint8)
    n = len(letters) - GRAM + 1
    mixed = letters[:n].astype(np.uint64)
    for j in range(1, GRAM):
        mixed = mixed * np.uint64(257) + letters[j : n + j]
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype("<u4").tobytes()


def pieces(word: bytes) -> set[bytes]:
    return {word[i : i + n] for n in LENGTHS for i in range(len(word) - n + 1)}


def stretches(word: bytes, telling: set[bytes]) -> list[bytes]:
    """The parts of a word that telling pieces cover."""
    covered = bytearray(len(word))
    for n in LENGTHS:
        for i in range(len(word) - n + 1):
            if word[i : i + n] in telling:
                covered[i : i + n] = b"\1" * n
    parts, start = [], None
    for i, c in enumerate([*covered, 0]):
        if c and start is None:
            start = i
        elif not c and start is not None:
            parts.append(word[start:i])
            start = None
    return parts


def signs(text: bytes) -> list[int]:
    """The least hash of SHINGLE words in a row by each of SIGNS; near copies share most."""
    hashes = np.array([zlib.crc32(w) for w in text.split()], np.uint64)
    n = max(1, len(hashes) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    for j in range(min(SHINGLE, len(hashes))):
        mixed = (mixed ^ hashes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    found = []
    for _ in range(SIGNS):
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        found.append(int(mixed.min() >> np.uint64(1)))
    return found


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the logistic weights of the measures and a constant."""

    toxic: bytes = b""
    ordinary: bytes = b""
    weights: tuple[float, ...] = ()


class Meter:
    """Measures texts; one per task, since compressors can't be sent to tasks."""

    def __init__(self, model: Model):
        self.compressors = [self._compressor(d) for d in (model.ordinary, model.toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=known,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )

    def measure(self, text: bytes | None) -> tuple[int, int, int]:
        """The best window's saving, the windows that save HIT or more, all windows."""
        coded = codes(plain(text or b""))
        ordinary, toxic = (c.compress for c in self.compressors)
        most = hits = windows = 0
        for at in range(0, max(4, len(coded) - 4 * (WINDOW - STEP)), 4 * STEP):
            window = coded[at : at + 4 * WINDOW]
            saved = len(ordinary(window)) - len(toxic(window))
            most = max(most, saved)
            hits += saved >= HIT
            windows += 1
        return most, hits, windows


def _terms(saved, hits, windows, log1p, log):
    """What the logistic weights apply to, from arrays or columns."""
    return saved, hits, hits / windows, log1p(hits), log(windows)


def sampled_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """The labelled ids that the model is fitted to: a table of bounded size."""
    digest = F.md5(F.col("label_id").cast("string"))
    rows = labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("toxic"))
    ones = rows.filter("toxic = 1").orderBy(digest, "label_id").limit(TOXIC_ROWS)
    zeros = rows.filter("toxic = 0").orderBy(digest, "label_id").limit(ORDINARY_ROWS)
    return written(ones.unionByName(zeros), "toxic-labels")


def _counts(rows: DataFrame, tokens_of, purpose: str) -> DataFrame:
    """token and n, the number of texts that hold it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for at in range(0, len(batch), SLICE):
                words: Counter = Counter()
                for text in texts.slice(at, SLICE).to_pylist():
                    words.update(word_set(text or b""))
                found: Counter = Counter()
                for word, n in words.items():
                    for token in tokens_of(word):
                        found[token] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                    names=["token", "n"],
                )

    found = rows.select("text").transform(arrow_map, counted, "token BINARY, n BIGINT")
    return written(found.groupBy("token").agg(F.sum("n").alias("n")), purpose)


def unlike(rows: DataFrame) -> DataFrame:
    """toxic and text: of the texts of a label that share a sign one stays, sign by sign."""
    names = [f"sign{k}" for k in range(SIGNS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([signs(t.as_py() or b"") for t in texts], np.int64)
            for name, values in zip(names, found.reshape(-1, SIGNS).T, strict=True):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    schema = ", ".join(["toxic INT", "text STRING", *(f"{name} BIGINT" for name in names)])
    left = rows.select("toxic", "text").transform(arrow_map, run, schema)
    for name in names:
        first = F.min(F.struct("text", *(n for n in names if n != name))).alias("first")
        left = left.groupBy("toxic", name).agg(first).select("toxic", name, "first.*")
    return written(left.select("toxic", "text"), "toxic-unlike")


def telling_pieces(toxic: DataFrame, ordinary: DataFrame, n_toxic: int, n_ordinary: int) -> set[bytes]:
    """The pieces that tell toxic texts.

    Only pieces that are significant if no ordinary text has them are collected.
    """
    least = max(PIECE_TEXTS, SIGNIFICANCE / (2 * math.log((n_toxic + n_ordinary) / n_toxic)) - 1e-6)
    often = _counts(toxic, pieces, "toxic-pieces").filter(F.col("n") >= least).collect()
    candidates = {bytes(r["token"]): r["n"] for r in often}
    known = frozenset(candidates)
    usual = _counts(ordinary, lambda word: pieces(word) & known, "ordinary-pieces").collect()
    seen = {bytes(r["token"]): r["n"] for r in usual}
    found = set()
    for piece, t in candidates.items():
        o = seen.get(piece, 0)
        expected = (t + o) * n_toxic / (n_toxic + n_ordinary)
        ratio = 2 * (t * math.log(t / expected) + (o and o * math.log(o / (t + o - expected))))
        if t / n_toxic >= PIECE_RATIO * (o + 0.5) / n_ordinary and ratio >= SIGNIFICANCE:
            found.add(piece)
    return found


def fit(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """The model from labelled documents; ``labels`` has doc_id and toxic (0 or 1)."""
    chosen = F.broadcast(sampled_labels(labels))
    rows = written(
        documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .join(chosen, F.col("doc_id") == F.col("label_id"))
        .select("text", "toxic"),
        "toxic-texts",
    )
    single = unlike(rows)
    sizes = {r["toxic"]: r["count"] for r in single.groupBy("toxic").count().collect()}
    if set(sizes) != {0, 1}:
        return Model()
    toxic, ordinary = single.filter("toxic = 1"), single.filter("toxic = 0")
    telling = telling_pieces(toxic, ordinary, sizes[1], sizes[0])
    best = (
        _counts(toxic, lambda word: stretches(word, telling), "toxic-stretches")
        .orderBy(F.desc("n"), "token")
        .limit(STRETCH_BYTES // 8)
        .collect()
    )
    common = (
        _counts(ordinary, lambda word: (word,), "ordinary-words")
        .orderBy(F.desc("n"), "token")
        .limit(ORDINARY_WORDS + STRETCH_BYTES // 4)
        .collect()
    )
    # The most frequent come last, where matches cost least; further words fill up the
    # ordinary dictionary to the length of the toxic one.
    base = b"".join(codes(bytes(r["token"])) for r in reversed(common[:ORDINARY_WORDS]))
    coded = [codes(bytes(r["token"])) for r in best]
    room = np.searchsorted(np.cumsum([len(c) for c in coded]), STRETCH_BYTES, "right")
    insults = b"".join(reversed(coded[:room]))
    filler = b"".join(codes(bytes(r["token"])) for r in common[ORDINARY_WORDS:])[: len(insults)]
    model = Model(insults + base, filler + base)
    found = measured(rows.select(F.col("toxic").cast("bigint").alias("doc_id"), "text"), model)
    groups = found.groupBy("doc_id", "saved", "hits", "windows").count().collect()
    columns = np.array([tuple(r) for r in groups], float).T
    weights = _logistic(
        np.stack(_terms(*columns[1:4], np.log1p, np.log)), columns[0], columns[4]
    )
    return replace(model, weights=weights)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, ...]:
    """Weights of the terms and a constant, by Newton steps on scaled terms.

    A little ridge keeps the weights of separable classes finite.
    """
    mean = np.average(x, axis=1, weights=n)
    scale = np.sqrt(np.average((x - mean[:, None]) ** 2, axis=1, weights=n)) + 1e-9
    columns = np.vstack([(x - mean[:, None]) / scale[:, None], np.ones(x.shape[1])])
    beta = np.zeros(len(columns))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ columns, -30, 30)))
        gradient = columns @ (n * (y - p)) - RIDGE * beta
        curvature = (columns * (n * p * (1 - p))) @ columns.T + RIDGE * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta += step * min(1.0, 3.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / scale
    return (*slopes.tolist(), float(beta[-1] - slopes @ mean))


def with_measures(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with saved, hits and windows, which replace columns of these names."""
    added = ("saved", "hits", "windows")
    own = documents.drop(*added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(model)
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            found = np.array([meter.measure(t.as_py()) for t in texts], np.int64).reshape(-1, 3)
            for name, values in zip(added, found.T, strict=True):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.transform(arrow_map, run, f"{schema}, saved BIGINT, hits BIGINT, windows BIGINT")


def measured(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, saved, hits and windows of every document."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return with_measures(rows, model).drop("text")


def score_column(model: Model):
    """The score from saved, hits and windows."""
    if not model.weights:
        return F.lit(0.0)
    *slopes, z = model.weights
    z = F.lit(z)
    terms = _terms(F.col("saved"), F.col("hits"), F.col("windows"), F.log1p, F.log)
    for slope, term in zip(slopes, terms, strict=True):
        z = z + F.lit(slope) * term
    return 1 / (1 + F.exp(-F.greatest(z, F.lit(-700.0))))


def scored(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    if not model.weights:
        return documents.select(F.col(doc_id).alias("doc_id"), F.lit(0.0).alias("score"))
    found = measured(documents, model, doc_id, text)
    return found.select("doc_id", score_column(model).alias("score"))


def ordinary(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that score less than one half."""
    if not model.weights:
        return documents
    names = {"saved", "hits", "windows"} & set(documents.columns)
    renamed = documents.withColumnsRenamed({n: f"__{n}" for n in names})
    kept = with_measures(renamed, model, f"__{text}" if text in names else text)
    kept = kept.filter(score_column(model) < 0.5).drop("saved", "hits", "windows")
    return kept.withColumnsRenamed({f"__{n}": n for n in names}).select(*documents.columns)


def held_out(doc_id: str = "doc_id", parts: int = 5, remainder: int = 0):
    """Whether the checksum of the id, as text, has that remainder."""
    checksum = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return checksum % parts == remainder


def learnt(documents: DataFrame, labels: DataFrame) -> Model:
    """The model from the labels that aren't held out."""
    return fit(documents, labels.filter(~held_out()))
