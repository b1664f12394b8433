"""n-gram language model in Elias-Fano tries, built and queried by Spark tasks.

Words are filed by 64-bit hashes; a word's id is its rank among the sorted hashes of the
vocabulary.  The entries of level k are numbers ``context * width + word``, where the
context is the entry's parent in level k - 1 (for level 2, a word id, or the beginning of
a text), so the children of a context lie side by side, and the sorted numbers are both
pointers and words in one Elias-Fano sequence.  An n-gram is looked up by a successor
search for its number within the context's stretch.  Each entry keeps a quantised log10
probability, and below the top level its count, which gives the back-off weight:

    p(w | context) = (count + KAPPA * p(w | shorter context)) / (context's count + KAPPA)

and add-one unigrams below.  Levels are cut into shard files of similar token mass; a
context that is frequent enough spans several.  Tasks map the files into memory and look
up many sorted n-grams at once, so each shard is passed through once per slice of texts.

All texts that aren't held out are counted, and nothing is pruned.  Counts are summed up
per task before they are shuffled, as sorted, difference-coded blocks.

Defined results: a null text counts as empty and has one token, the end; a null id counts
as the empty string for the choice of held-out rows; unknown words have the probability of
a word of count 0 and are no context; without training texts every token has probability
1; repeated rows count as often as they stand there; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, new_folder, opened, put_file, stored
from millrace.llm.elias_fano import EliasFano

ORDER = 3
KAPPA = 200.0
VOCABULARY_SHARD = 1_000_000
SHARD_TOKENS = 2_000_000
SLICE = 2000
HELD_TOKENS = 4_000_000
LONG_WORD = 64  # bytes
END = b" "  # no word holds white space
WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _hashed(data: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of the data, which goes on for eight bytes after the last.

    Eight bytes of all stretches are mixed in at a time; long ones are hashed one by one.
    """
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # from any byte on
    hashes = _mixed(size.astype(np.uint64) + np.uint64(1))
    rest = np.flatnonzero(size <= LONG_WORD)
    at, left = begin[rest], size[rest]
    while len(rest):
        hashes[rest] = _mixed(hashes[rest] ^ (eight[at] & FIRST_BYTES[np.minimum(left, 8)]))
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[begin[i] : begin[i] + size[i]])
    return hashes


def hashes_of(words: list[bytes]) -> np.ndarray:
    size = np.array([len(w) for w in words], np.int64)
    return _hashed(b"".join(words) + bytes(8), np.cumsum(size) - size, size)


def numbered(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words' hashes, ascending, all tokens as numbers of them, and each text's
    first place."""
    parts = [text or b"" for text in texts]
    data = b"".join([b" ", b" ".join(parts).lower(), b" ", bytes(8)])
    white = WHITE[np.frombuffer(data, np.uint8, len(data) - 8)]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1  # words begin and end by turns
    begin, end = edges[::2], edges[1::2]
    # The words before each text's end, and its end token, which comes after them.
    stops = np.cumsum([len(part) + 1 for part in parts], dtype=np.int64)
    ends = np.searchsorted(begin, stops, "right") + np.arange(len(parts))
    hashes = np.full(len(begin) + len(parts), hashes_of([END])[0], np.uint64)
    words = np.ones(len(hashes), bool)
    words[ends] = False
    hashes[words] = _hashed(data, begin, end - begin)
    distinct, tokens = np.unique(hashes, return_inverse=True)
    return distinct, tokens, np.concatenate([[0], ends + 1])[: len(parts)].astype(np.int64)


# Files of arrays.


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    head, parts, at = {}, [], 0
    for name, array in arrays.items():
        head[name] = (array.dtype.str, len(array), at)
        data = array.tobytes()
        parts.append(data + b"\0" * (-len(data) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return b"".join([len(text).to_bytes(8, "little"), text, *parts])


class Opened(dict):
    """The arrays of files by path.  Functions are sent with what their modules hold; the
    arrays of files that are open here stay here."""

    def __reduce__(self):
        return Opened, ()


_open = Opened()


def unpacked(path: str) -> dict[str, np.ndarray]:
    """The file's arrays, mapped into memory where the file system allows it."""
    if path not in _open:
        if len(_open) > 4096:
            _open.clear()
        system, inner = opened(path)
        if isinstance(system, fs.LocalFileSystem):
            data = pa.memory_map(inner).read_buffer()
        else:
            with system.open_input_file(inner) as file:
                data = file.read_buffer()
        size = int.from_bytes(memoryview(data)[:8], "little")
        head = json.loads(bytes(memoryview(data)[8 : 8 + size]))
        _open[path] = {
            name: np.frombuffer(data, kind, n, 8 + size + at) for name, (kind, n, at) in head.items()
        }
    return _open[path]


def sequence_arrays(numbers: np.ndarray, limit: int) -> dict[str, np.ndarray]:
    return {f"ef{i}": a for i, a in enumerate(EliasFano.encode(numbers, limit).arrays())}


def sequence(arrays: dict[str, np.ndarray]) -> EliasFano:
    return EliasFano.of([arrays[f"ef{i}"] for i in range(4)])


# Sorted numbers and their counts as blocks.


def squeezed(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, with the sums of their counts."""
    order = np.argsort(numbers, kind="stable")
    numbers, counts = numbers[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[firsts], np.add.reduceat(counts, firsts)


@dataclass
class Parts:
    """Files, the first number that each may hold, and the entries before each."""

    paths: list[str] = field(default_factory=list)
    firsts: list[int] = field(default_factory=list)
    limits: list[int] = field(default_factory=list)
    bases: list[int] = field(default_factory=list)
    n: int = 0

    def _stretches(self, borders: list[int], asked: np.ndarray):
        """The parts that ascending numbers fall into, each with its stretch of them."""
        which = np.searchsorted(np.array(borders, asked.dtype), asked, "right") - 1
        cuts = np.flatnonzero(np.diff(which, prepend=-2, append=-2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if which[a] >= 0:
                yield int(which[a]), a, b

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """Entries of ascending numbers, -1 for those that aren't there."""
        found = np.full(len(numbers), -1, np.int64)
        if not self.paths:
            return found
        for part, a, b in self._stretches(self.firsts, numbers):
            first, limit = self.firsts[part], self.limits[part]
            b = a + int(np.searchsorted(numbers[a:b], np.array(limit, numbers.dtype)))
            shift = numbers[a:b].astype(np.uint64) - np.uint64(first)
            index = sequence(unpacked(self.paths[part])).find(shift)
            found[a:b] = np.where(index < 0, -1, index + self.bases[part])
        return found

    def values(self, name: str, entries: np.ndarray, extra: int = 0) -> np.ndarray:
        """An array's integers (``extra``: those that many places on) at any entries."""
        ascending = not (entries[1:] < entries[:-1]).any()
        order = np.arange(len(entries)) if ascending else np.argsort(entries, kind="stable")
        sorted_ = entries[order]
        out = np.zeros(len(entries), np.int64)  # the files hold the least type they can
        for part, a, b in self._stretches(self.bases, sorted_):
            places = sorted_[a:b] - self.bases[part] + extra
            out[order[a:b]] = unpacked(self.paths[part])[name][places]
        return out

    def numbers(self, entries: np.ndarray) -> np.ndarray:
        """The numbers of any entries."""
        order = np.argsort(entries, kind="stable")
        sorted_ = entries[order]
        out = np.zeros(len(entries), np.int64)
        for part, a, b in self._stretches(self.bases, sorted_):
            own = sequence(unpacked(self.paths[part]))
            out[order[a:b]] = own.at(sorted_[a:b] - self.bases[part]).astype(np.int64) + self.firsts[part]
        return out


@dataclass
class Model:
    """Where the levels are; ``levels[0]`` is the vocabulary."""

    order: int
    kappa: float
    tokens: int = 0
    texts: int = 0
    levels: list[Parts] = field(default_factory=list)

    @property
    def words(self) -> int:
        return self.levels[0].n

    @property
    def width(self) -> int:
        """Words, and one more: the id of the beginning of a text."""
        return self.words + 1

    @property
    def step(self) -> float:
        return math.log10(self.tokens + self.kappa + 1) / 255

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """The ids of ascending hashes, -1 for unknown words."""
        return self.levels[0].find(hashes)

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of words, 0 for unknown ones; of the beginning, the texts."""
        counts = np.zeros(len(ids), np.int64)
        known = np.flatnonzero((ids >= 0) & (ids < self.words))
        vocabulary = self.levels[0]
        before = vocabulary.values("before", ids[known])
        counts[known] = vocabulary.values("before", ids[known], 1) - before
        counts[ids == self.words] = self.texts
        return counts

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))

    def context_counts(self, level: int, contexts: np.ndarray) -> np.ndarray:
        """How often the contexts of entries of a level were seen."""
        if level == 2:
            return self.word_counts(contexts)
        return self.levels[level - 2].values("counts", contexts)

    def log_probabilities(self, level: int, entries: np.ndarray) -> np.ndarray:
        return -self.step * self.levels[level - 1].values("quantised", entries)

    def look_up(self, level: int, numbers: np.ndarray) -> np.ndarray:
        """Entries of numbers in any order."""
        distinct, which = np.unique(numbers, return_inverse=True)
        return self.levels[level - 1].find(distinct)[which]

    def shorter(self, level: int, entries: np.ndarray) -> np.ndarray:
        """The entries of a level without their first word, in the level below."""
        numbers = self.levels[level - 1].numbers(entries)
        if level == 2:
            return numbers % self.width
        contexts = self.shorter(level - 1, numbers // self.width)
        return self.look_up(level - 1, contexts * self.width + numbers % self.width)


@dataclass
class Slice:
    """Some texts' tokens: word ids, -1 where unknown, and the words' counts."""

    model: Model
    ids: np.ndarray
    counts: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, model: Model, texts: list[bytes | None]) -> Slice:
        hashes, tokens, starts = numbered(texts)
        ids = model.word_ids(hashes)
        return cls(model, ids[tokens], model.word_counts(ids)[tokens], starts)

    def after(self, values: np.ndarray, first: int) -> np.ndarray:
        """The value of what each token has before it; ``first`` where a text starts."""
        before = np.concatenate([[first], values[:-1]])
        before[self.starts] = first
        return before

    def numbers(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words in known contexts, and their numbers in the level."""
        places = np.flatnonzero((contexts >= 0) & (self.ids >= 0))
        return places, contexts[places] * self.model.width + self.ids[places]

    def beginning(self) -> int:
        return self.model.words if self.model.texts else -1

    def contexts(self, level: int) -> np.ndarray:
        """The contexts of a level at every token, -1 where there is none."""
        contexts = self.after(self.ids, self.beginning())
        for below in range(2, level):
            places, numbers = self.numbers(contexts)
            entries = np.full(len(self.ids), -1, np.int64)
            entries[places] = self.model.look_up(below, numbers)
            contexts = self.after(entries, -1)
        return contexts

    def log_probabilities(self) -> tuple[np.ndarray, np.ndarray]:
        """Each token's unigram and model log10 probability."""
        model = self.model
        unigram = model.unigram(self.counts)
        logs = unigram.copy()
        contexts = self.after(self.ids, self.beginning())
        held = self.after(self.counts, model.texts)
        for level in range(2, model.order + 1):
            seen = np.flatnonzero(contexts >= 0)
            logs[seen] += np.log10(model.kappa / (held[seen] + model.kappa))
            places, numbers = self.numbers(contexts)
            distinct, which = np.unique(numbers, return_inverse=True)
            found = model.levels[level - 1].find(distinct)
            hits = np.flatnonzero(found >= 0)
            exact = np.full(len(distinct), np.nan)
            exact[hits] = model.log_probabilities(level, found[hits])
            exact = exact[which]
            known = ~np.isnan(exact)
            logs[places[known]] = exact[known]
            if level < model.order:
                counts = np.zeros(len(distinct), np.int64)
                counts[hits] = model.levels[level - 1].values("counts", found[hits])
                entries, seen_before = (np.full(len(self.ids), x, np.int64) for x in (-1, 0))
                entries[places], seen_before[places] = found[which], counts[which]
                contexts, held = self.after(entries, -1), self.after(seen_before, 0)
        return unigram, logs


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part = batch.slice(at, SLICE)
            yield part, part.column(column).cast(pa.binary()).to_pylist()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> pa.RecordBatch:
        hashes, counts = summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "n"]
        )

    for _, texts in _texts(batches, 0):
        hashes, tokens, _ = numbered(texts)
        held.append((hashes, np.bincount(tokens, minlength=len(hashes))))
        size += len(hashes)
        if size > HELD_TOKENS:
            yield merged()
            held, size = [], 0
    if held:
        yield merged()


def _build_vocabulary(texts: DataFrame, folder: str) -> tuple[Parts, int]:
    table = stored(
        texts.transform(arrow_map, _count_words, "hash BIGINT, n BIGINT", SLICE)
        .groupBy("hash")
        .agg(F.sum("n").alias("n")),
        "lm-words",
    )
    counts = table.rows
    words = counts.count()
    if not words:
        return Parts(), 0
    shards = -(-words // VOCABULARY_SHARD)
    place = F.shiftright(F.shiftrightunsigned("hash", 33) * F.lit(shards).cast("bigint"), 31)
    placed = counts.withColumn("shard", place)
    sums = placed.groupBy("shard").agg(F.count(F.lit(1)), F.sum("n")).orderBy("shard").collect()
    bases, masses, entries, mass = {}, {}, 0, 0
    for shard, n, tokens in sums:
        bases[shard], masses[shard] = entries, mass
        entries, mass = entries + n, mass + tokens

    def build(key, table):
        shard = key[0].as_py()
        hashes = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        first, limit = int(hashes.min()), int(hashes.max()) + 1
        before = np.cumsum(np.concatenate([[masses[shard]], table.column("n").to_numpy()[order]]))
        path = f"{folder}/words-{shard:06d}"
        arrays = sequence_arrays(hashes[order] - np.uint64(first), limit - first)
        put_file(path, pack(arrays | {"before": before.astype(np.int64)}))
        return _part(path, first, limit, len(hashes))

    parts = _parts(placed.groupBy("shard").applyInArrow(build, PART), "lm-vocabulary")
    table.discard()
    return parts, mass


PART = "path STRING, first STRING, last STRING, n BIGINT"


def _part(path: str, first: int, limit: int, n: int) -> pa.Table:
    # Unsigned 64-bit numbers and their limit as text: no type of Spark holds them.
    return pa.table(
        {"path": [path], "first": [str(first)], "last": [str(limit)], "n": pa.array([n], pa.int64())}
    )


def _parts(files: DataFrame, purpose: str) -> Parts:
    table = stored(files, purpose)
    rows = sorted((int(r["first"]), int(r["last"]), r["path"], r["n"]) for r in table.rows.collect())
    table.discard()
    parts = Parts()
    for first, limit, path, n in rows:
        parts.paths.append(path)
        parts.firsts.append(first)
        parts.limits.append(limit)
        parts.bases.append(parts.n)
        parts.n += n
    return parts


def _count_level(model: Model, level: int, shards: int):
    """Blocks of the level's numbers and counts, by shard."""

    def shard_of(numbers: np.ndarray) -> np.ndarray:
        contexts, words = numbers // model.width, numbers % model.width
        if level > 2:
            return contexts * shards // max(1, model.levels[level - 2].n)
        ids, which = np.unique(contexts, return_inverse=True)
        inside = np.minimum(ids, model.words - 1)
        before = model.levels[0].values("before", inside)
        before[ids == model.words] = model.tokens
        share = model.word_counts(ids)[which] * (words / model.width)
        mass = before[which] + share
        return np.minimum(shards - 1, (mass * shards / (model.tokens + model.texts)).astype(np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def blocks() -> pa.RecordBatch:
            numbers, counts = np.unique(np.concatenate(held), return_counts=True)
            shard = shard_of(numbers)
            cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)).tolist()
            rows = [
                {
                    "shard": int(shard[a]),
                    "numbers": squeezed(np.diff(numbers[a:b], prepend=0)),
                    "counts": squeezed(counts[a:b]),
                }
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            kinds = [("shard", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary())]
            return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

        for _, texts in _texts(batches, 0):
            some = Slice.of(model, texts)
            _, numbers = some.numbers(some.contexts(level))
            held.append(numbers)
            size += len(numbers)
            if size > HELD_TOKENS:
                yield blocks()
                held, size = [], 0
        if size:
            yield blocks()

    return count


def _build_level(model: Model, level: int, texts: DataFrame, folder: str) -> Parts:
    shards = -(-(model.tokens + model.texts) // SHARD_TOKENS)
    contexts = model.levels[level - 2].n + 1
    if contexts * model.width >= 2**63:
        raise OverflowError(
            f"{contexts} contexts of {model.width} words each have no 64-bit numbers"
        )

    def build(key, table):
        shard = key[0].as_py()
        blocks = [np.cumsum(unsqueezed(b)) for b in table.column("numbers").to_pylist()]
        counts = [unsqueezed(b) for b in table.column("counts").to_pylist()]
        numbers, n = summed(np.concatenate(blocks).astype(np.int64), np.concatenate(counts).astype(np.int64))
        del blocks, counts
        contexts, words = numbers // model.width, numbers % model.width
        if level == 2:
            lower = model.unigram(model.word_counts(words))
        else:
            below = model.shorter(level - 1, contexts) * model.width + words
            lower = model.log_probabilities(level - 1, model.look_up(level - 1, below))
        seen = model.context_counts(level, contexts)
        logs = np.log10((n + model.kappa * 10**lower) / (seen + model.kappa))
        quantised = np.clip(np.rint(-logs / model.step), 0, 255).astype(np.uint8)
        first, limit = int(numbers[0]), int(numbers[-1]) + 1
        arrays = sequence_arrays(numbers - first, limit - first) | {"quantised": quantised}
        if level < model.order:
            arrays["counts"] = n.astype(np.min_scalar_type(int(n.max())))
        path = f"{folder}/level{level}-{shard:06d}"
        put_file(path, pack(arrays))
        return _part(path, first, limit, len(numbers))

    columns = "shard BIGINT, numbers BINARY, counts BINARY"
    blocks = texts.transform(arrow_map, _count_level(model, level, shards), columns, SLICE)
    return _parts(blocks.groupBy("shard").applyInArrow(build, PART), f"lm-level{level}")


def train(documents: DataFrame, text: str = "text", order: int = ORDER, kappa: float = KAPPA) -> Model:
    """The model of all the documents' texts."""
    texts = documents.select(F.col(text).alias("text"))
    folder = new_folder(documents.sparkSession, "lm")
    model = Model(order, kappa)
    vocabulary, model.tokens = _build_vocabulary(texts, folder)
    model.levels.append(vocabulary)
    if model.tokens:
        model.texts = int(model.word_counts(model.word_ids(hashes_of([END])))[0])
        _open.clear()  # the driver needs the vocabulary no more
    for level in range(2, order + 1):
        model.levels.append(_build_level(model, level, texts, folder) if model.tokens else Parts())
    return model


def scored(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            some = Slice.of(model, texts)
            known = (some.counts > 0).astype(np.int64)
            sums = [np.add.reduceat(x, some.starts) for x in (known, *some.log_probabilities())]
            sizes = np.diff(np.append(some.starts, len(some.ids)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), *map(pa.array, sums)],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    columns = "doc_id BIGINT, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"
    return rows.transform(arrow_map, score, columns, SLICE)


def held_out(doc_id: str = "doc_id", parts: int = 7, remainder: int = 2) -> Column:
    """Whether the checksum of the id, as text, has that remainder."""
    checksum = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return checksum % parts == remainder
