"""Token ids of documents in Re-Pair compressed shard files.

Documents are put in ascending order of their ids, cut into shards of about
``SHARD_BYTES`` of text, encoded, and compressed with a grammar per shard.  A file is
written by one task under a draft name and moved into place, so a repeated task changes
nothing.  Reading takes one task per file.

A file holds, little-endian: the 8 bytes ``RPAIR01\\n``; six unsigned 64-bit numbers
(documents, ids, base, rules, symbols, high planes); document ids (int64) and their null
flags (bytes); the ids up to each document's end (uint64); rules (uint32 pairs) and their
expansion lengths (uint32); the id position before every 1024th symbol (uint64); the low
16 bits of the symbols (uint16); one bit plane for each further bit.

Defined results: a null text has no ids but the end id; null document ids come first;
rows with the same id are all kept, in the order of a hash of their texts; an empty table
gives no rows; columns other than the two named are left out.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, kept, new_folder, opened, put_file, trim, written
from millrace.llm.repair import Grammar, compress

SHARD_BYTES = 8 << 20
MAGIC = b"RPAIR01\n"
CACHED_PIECES = 300_000
JOINED = 5000
BATCH_ROWS = 4000  # of at most 8 MiB
CUT_BYTES = 1 << 20  # of texts that are cut at a time


@dataclass
class Pieces:
    """Pieces that were met, and their ids in a row; ``sizes`` is -1 for pieces that can't
    be encoded alone.

    ``older`` are pieces that the last texts didn't hold, the latest first; those beyond
    ``CACHED_PIECES`` are forgotten.
    """

    words: pa.StringArray = field(default_factory=lambda: pa.array([], pa.string()))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u4"))
    older: Pieces | None = None

    def __len__(self) -> int:
        return len(self.words)

    def at(self, places: np.ndarray) -> Pieces:
        return Pieces(self.words.take(pa.array(places)), self.sizes[places], self.ids_at(places))

    def ids_at(self, places: np.ndarray) -> np.ndarray:
        """The ids of the pieces at the places, in a row."""
        room = np.maximum(self.sizes, 0)
        begin = (np.cumsum(room, dtype=np.int32) - room)[places]
        room = room[places]
        source = np.repeat(begin - (np.cumsum(room, dtype=np.int32) - room), room)
        source += np.arange(len(source), dtype=np.int32)
        return self.ids[source]

    @staticmethod
    def joined(parts: list[Pieces]) -> Pieces:
        return Pieces(
            pa.concat_arrays([p.words for p in parts]),
            np.concatenate([p.sizes for p in parts]),
            np.concatenate([p.ids for p in parts]),
        )


# Kinds of bytes.  A plain piece holds visible ASCII characters but the apostrophe, Latin
# letters of two bytes, and single line ends inside; in it the byte-level pre-tokens begin
# where the kind changes, and the space in front of the piece belongs to the first.
BLANK, LINE_END, LETTER, DIGIT, SIGN, ODD = range(6)
KINDS = np.full(256, ODD, np.uint8)
KINDS[33:127] = SIGN
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
KINDS[48:58], KINDS[ord("'")] = DIGIT, ODD
KINDS[ord(" ")], KINDS[ord("\n")] = BLANK, LINE_END
LATIN = 0xC3  # the first byte of À to ÿ, of which × and ÷ are no letters
NO_LETTERS = (0x97, 0xB7)
PRE_TOKEN = r"^(\n| ?([A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[!-&(-/:-@\[-`{-~]+))$"
# The character that stands for each byte in the vocabulary.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
SHOWN = np.zeros(256, "<u2")
SHOWN[PRINTED] = PRINTED
SHOWN[SHOWN == 0] = np.arange(256, 512 - len(PRINTED))


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in a row, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _parts(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    """The texts in stretches of about ``CUT_BYTES``; a longer text stands alone."""
    ends = _bytes(texts)[1][1:]
    at = 0
    while at < len(texts):
        begin = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, begin + CUT_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


def _cut(texts: pa.StringArray, plain: bool) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of the texts, each with the space in front of it, and how many come
    before each text and its end; ``plain`` ones cut into pre-tokens."""
    data, offsets = _bytes(texts)
    starts = np.zeros(len(data) + 1, bool)
    starts[:-1] = data == ord(" ")
    starts[offsets] = True
    if plain and len(data):
        kinds = KINDS[data]
        odd = kinds == ODD
        latin = np.flatnonzero(data == LATIN)
        high = data > 127
        high[latin] = high[latin + 1] = False
        odd |= high
        odd[latin] |= np.isin(data[latin + 1], NO_LETTERS)
        lines = np.flatnonzero(kinds == LINE_END)
        edge = starts[lines] | starts[lines + 1]
        edge |= (kinds[lines - 1] <= LINE_END) | (np.append(kinds, BLANK)[lines + 1] <= LINE_END)
        odd[lines] |= edge
        pieces = np.flatnonzero(starts[:-1])
        odd = np.repeat(np.logical_or.reduceat(odd, pieces), np.diff(pieces, append=len(data)))
        change = kinds[1:] != kinds[:-1]
        change &= kinds[:-1] != BLANK
        change &= ~odd[1:]
        starts[1:-1] |= change
    begin = np.flatnonzero(starts).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin), pa.py_buffer(data))
    return pieces, np.searchsorted(begin, offsets)


class PieceEncoder:
    """Encodes texts by their pieces between single spaces, each new piece but once.

    The byte-level pre-tokenizer never joins a word to what stands before the space in
    front of it, so a text's ids are those of its pieces in a row.  Where white space
    follows the space this doesn't hold; such texts are encoded whole, as are those with
    special tokens.  Plain pieces are cut into their pre-tokens, which reach the model as
    lines.  New pieces are encoded many at a time, and told apart again by the lengths of
    their tokens.
    """

    def __init__(self, path: str):
        # A task has one core; the library's threads would only cost memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # In this vocabulary each character of a token stands for one byte.
        self.lengths = np.zeros(self.base, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.lengths[i] = len(token)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [str(token.content) for token in added.values()]
        self.pieces = Pieces(older=Pieces())
        self.lines = None
        cuts = self.tokenizer.pre_tokenizer
        if (
            isinstance(self.tokenizer.model, models.BPE)
            and isinstance(cuts, pre_tokenizers.ByteLevel)
            and (cuts.use_regex, cuts.add_prefix_space) == (True, False)
            and self.tokenizer.normalizer is None
        ):
            self.lines = Tokenizer(self.tokenizer.model)
            self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        tokenizer = tokenizer or self.tokenizer
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _told_apart(self, words: pa.StringArray, ids: list[np.ndarray]) -> Pieces:
        joined = np.concatenate([np.zeros(0, "<u4"), *ids])
        ends = _bytes(words)[1]
        cuts = np.searchsorted(np.cumsum(self.lengths[joined]), ends[1:]) + 1
        return Pieces(words, np.diff(cuts, prepend=0).astype(np.int32), joined)

    def _learnt(self, words: pa.StringArray) -> Pieces:
        """The ids of distinct pieces."""
        parts = []
        if self.lines:
            cut = pc.match_substring_regex(words, PRE_TOKEN)
            plain, words, ids = words.filter(cut), words.filter(pc.invert(cut)), []
            for at in range(0, len(plain), JOINED):
                data, offsets = _bytes(plain.slice(at, JOINED))
                shown = np.insert(SHOWN[data], offsets[1:-1], ord("\n"))
                ids += self._ids([shown.tobytes().decode("utf-16-le")], self.lines)
            parts.append(self._told_apart(plain, ids))
        odd = words.to_pylist()
        after = np.array([x[0] == " " for x in odd], bool)
        safe = [len(x) > 1 and not x[1].isspace() for x in odd]
        safe = after & np.array(safe, bool)
        joined, ids = words.filter(pa.array(safe)), []
        for at in range(0, len(joined), JOINED):
            ids += self._ids(["".join(joined.slice(at, JOINED).to_pylist())])
        parts.append(self._told_apart(joined, ids))
        # What stands first in a text is encoded by itself.
        ids = self._ids(words.filter(pa.array(~after)).to_pylist())
        sizes = np.array([len(x) for x in ids], np.int32)
        firsts = words.filter(pa.array(~after))
        parts.append(Pieces(firsts, sizes, np.concatenate([np.zeros(0, "<u4"), *ids])))
        unsafe = words.filter(pa.array(after & ~safe))
        parts.append(Pieces(unsafe, np.full(len(unsafe), -1, np.int32)))
        return Pieces.joined(parts)

    def _look_up(self, words: pa.StringArray) -> np.ndarray:
        """Places of the distinct words in ``pieces``, which holds just them from now on."""
        known = Pieces.joined([self.pieces, self.pieces.older])
        place = pc.index_in(words, known.words)
        met = place.drop_null().to_numpy()
        left = np.ones(len(known), bool)
        left[met] = False
        older = known.at(np.flatnonzero(left)[:CACHED_PIECES])
        learnt = self._learnt(words.filter(place.is_null()))
        self.pieces = Pieces.joined([known.at(met), learnt])
        self.pieces.older = older
        return pc.index_in(words, self.pieces.words).to_numpy()

    def encode(self, texts: pa.StringArray | list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        some = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        coded, starts = [], []
        for part in _parts(some):
            pieces, start = _cut(part, self.lines is not None)
            coded.append(pieces.dictionary_encode())
            starts.append(start)
        coded = pa.chunked_array(coded, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries()
        places = self._look_up(coded.chunk(0).dictionary) if coded.num_chunks else None
        out, unsafe = [], []
        for part, start in zip(coded.iterchunks(), starts, strict=True):
            which = places[part.indices.to_numpy()]
            sizes = self.pieces.sizes[which]
            odd = np.concatenate([[0], np.cumsum(sizes < 0)])[start]
            unsafe.append(odd[1:] > odd[:-1])
            ids = self.pieces.ids_at(which).tobytes()
            stops = 4 * np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])[start]
            out += [ids[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
        whole |= np.concatenate([np.zeros(0, bool), *unsafe])
        again = np.flatnonzero(whole).tolist()
        for i, found in zip(again, self._ids([texts[i].as_py() for i in again]), strict=True):
            out[i] = found.tobytes()
        return out


def _kept_name(path: str) -> str:
    return f"pieces of {path}"


def _encoder(path: str) -> PieceEncoder:
    return kept(_kept_name(path), lambda: PieceEncoder(path))


def pack(doc_ids: list[int | None], ends: np.ndarray, grammar: Grammar) -> bytes:
    symbols = grammar.symbols
    planes = max(0, int(grammar.base + len(grammar.rules) - 1).bit_length() - 16)
    high = [np.packbits((symbols >> (16 + p)) & 1).tobytes() for p in range(planes)]
    head = struct.pack(
        "<6Q",
        len(doc_ids),
        int(ends[-1]) if len(ends) else 0,
        grammar.base,
        len(grammar.rules),
        len(symbols),
        planes,
    )
    return b"".join(
        [
            MAGIC,
            head,
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            ends.astype("<u8").tobytes(),
            grammar.rules.astype("<u4").tobytes(),
            grammar.lengths.astype("<u4").tobytes(),
            grammar.positions().astype("<u8").tobytes(),
            (symbols & 0xFFFF).astype("<u2").tobytes(),
            *high,
        ]
    )


class TokenFile:
    """A shard file's documents, any of which can be decoded by itself."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n, self.n_ids, base, rules, symbols, planes = struct.unpack_from("<6Q", data, 8)
        at = 56

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        ids, nulls = take(n, "<i8"), take(n, "u1")
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, nulls, strict=True)]
        self.ends = take(n, "<u8").astype(np.int64)
        pairs, lengths = take(2 * rules, "<u4").reshape(-1, 2), take(rules, "<u4")
        self.positions = take(-(-symbols // 1024), "<u8").astype(np.int64)
        low = take(symbols, "<u2").astype(np.int32)
        for p in range(planes):
            bits = np.unpackbits(take(-(-symbols // 8), "u1"), count=symbols)
            low |= bits.astype(np.int32) << (16 + p)
        self.grammar = Grammar(base, pairs, lengths, low)

    def document(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else 0
        return self.grammar.between(start, int(self.ends[i]), self.positions)

    def all_ids(self) -> np.ndarray:
        return self.grammar.expand(self.grammar.symbols)


def _writer(folder: str, vocabulary: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        end = struct.pack("<I", end_id)
        doc_ids: list[int | None] = []
        encoded: list[bytes] = []
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            encoded += [x + end for x in encoder.encode(batch.column(1))]
        if not doc_ids:
            return
        ends = np.cumsum([len(x) // 4 for x in encoded])
        ids = np.frombuffer(b"".join(encoded), "<u4")
        del encoded
        trim()  # makes room for the grammar
        data = pack(doc_ids, ends, compress(ids, max(encoder.base, end_id + 1)))
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}.rpair"
        put_file(path, data)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": path, "docs": len(doc_ids), "ids": len(ids), "bytes": len(data)}]
        )

    return write


def write_tokens(
    documents: DataFrame,
    vocabulary: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the shard files; the rows name shard, path, docs, ids and bytes of each."""
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), body)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    folder = new_folder(documents.sparkSession, "tokens")
    files = (
        rows.repartitionByRange(max(1, -(-total // shard_bytes)), *order)
        .sortWithinPartitions(*order)
        .transform(
            arrow_map,
            _writer(folder, vocabulary, end_id),
            "shard BIGINT, path STRING, docs BIGINT, ids BIGINT, bytes BIGINT",
            BATCH_ROWS,
            _kept_name(vocabulary),
        )
    )
    return written(files, "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, inner = opened(row["path"])
            with system.open_input_file(inner) as source:
                file = TokenFile(source.read())
            ids = memoryview(file.all_ids().astype("<u4")).cast("B")
            starts = np.concatenate([[0], file.ends])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file.doc_ids, pa.int64()),
                    pa.array(starts[:-1] + row["start"], pa.int64()),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.array(
                        [
                            zlib.crc32(ids[4 * a : 4 * b])
                            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
                        ],
                        pa.int64(),
                    ),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the ids' checksum.

    The prefix sum over the files has one row per shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start")
    placed = files.select("path", start)
    return placed.repartition(max(1, files.count()), "path").transform(
            arrow_map,
        _read, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    )
