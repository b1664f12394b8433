"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints of 64 bits link at ``LINK_BITS`` or fewer differing bits.  Of two linked
fingerprints, one of the two halves differs in at most two bits.  So each fingerprint is
filed, for each half, under the half itself and under the 32 values one bit away: halves
at most two bits apart meet under a value between them.  Every meeting is checked against
the whole distance.

Equal fingerprints are filed once.  Under one value, links are merged at once, so that a
group of k fingerprints leaves at most k - 1 edges and never all its pairs.  A value with
more than ``RUN_LIMIT`` fingerprints is cut into chunks, and every two chunks are checked
in a task of their own: nothing is dropped, and memory stays bounded.

Defined results: a null text counts as empty; texts without words have fingerprint 0 and
link like others; a null id joins its component without naming it; repeated rows are all
returned; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, written
from millrace.llm.components import components

LINK_BITS = 4
SHINGLE = 4
SEED = 42
RUN_LIMIT = 4096
EDGES = "run BIGINT, chunk INT, a BIGINT, b BIGINT"


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The majority bit of the shingles' hashes, for each of 64 bits."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(
            hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash and fp, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            found = np.fromiter(
                (fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(batch)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return rows.transform(arrow_map, run, "doc_id BIGINT, text_hash BIGINT, fp BIGINT")


def _links(fps: np.ndarray, tag: np.ndarray, upper: bool) -> list[tuple[int, int]]:
    """Fewest edges that connect what the links among fingerprints of one value connect.

    ``tag`` is the bit in which the half differs from the value, 0 for none.  Two halves
    that meet under several values count under one: equal halves under themselves, others
    under the lesser value.
    """
    if len(fps) < 2 or (tag == tag[0]).all() and tag[0]:
        return []
    half = (fps >> np.uint64(32) if upper else fps) & np.uint64(0xFFFFFFFF)
    value = half ^ tag
    label = np.arange(len(fps))
    edges = []
    for i in range(1, len(fps)):
        # Halves that differ in tag[i] ^ tag[:i] meet under value and value ^ difference.
        apart = tag[:i] ^ tag[i]
        counts = np.where(apart == 0, tag[i] == 0, value[:i] < (value[:i] ^ apart))
        near = counts & (np.bitwise_count(fps[:i] ^ fps[i]) <= LINK_BITS)
        for root in np.unique(label[:i][near]):
            edges.append((int(fps[root]), int(fps[i])))
            label[label == root] = i
    return edges


def _runs(limit: int | None):
    """Edges of sorted runs; runs beyond the limit are handed on in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_run: tuple | None = None
        held_rows = chunk = 0
        out: list[tuple] = []

        def flushed(rows: np.ndarray, last: bool) -> None:
            nonlocal chunk
            if limit and (chunk or not last):
                out.extend((int(held_run[0]), chunk, int(f), 0) for f in rows.view(np.int64))
                chunk = chunk + 1 if not last else 0
            else:
                out.extend(pairs(held_run[0], rows))

        def pairs(key: int, rows: np.ndarray) -> list[tuple]:
            upper, value = key >> 32, np.uint64(key & 0xFFFFFFFF)
            half = (rows >> np.uint64(32) if upper else rows) & np.uint64(0xFFFFFFFF)
            found = _links(rows, half ^ value, bool(upper))
            return [(None, None, *np.array(e, np.uint64).view(np.int64).tolist()) for e in found]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else ((),) * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["run", "chunk", "a", "b"],
            )

        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(3)]
            fps = batch.column(3).to_numpy().view(np.uint64)
            change = np.zeros(len(fps), bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change)])
            ends = np.concatenate([starts[1:], [len(fps)]])
            # Alone inside the batch: neither first nor last run, and of one row.
            several = np.flatnonzero(
                (ends - starts > 1) | (starts == 0) | (ends == len(fps))
            )
            for i in several:
                start, end = int(starts[i]), int(ends[i])
                here = tuple(int(k[start]) for k in keys)
                if here != held_run:
                    if held_run is not None:
                        flushed(np.concatenate(held), last=True)
                    held, held_rows, held_run, chunk = [], 0, here, 0
                held.append(fps[start:end])
                held_rows += end - start
                while limit and held_rows > limit:
                    rows = np.concatenate(held)
                    flushed(rows[:limit], last=False)
                    held, held_rows = [rows[limit:]], len(rows) - limit
            if out:
                yield batch_of(out)
                out = []
        if held_run is not None:
            flushed(np.concatenate(held), last=True)
        yield batch_of(out)

    return run


def links(fps: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints exactly as their links do."""
    half = lambda s: F.shiftrightunsigned("fp", 32 * s).bitwiseAND(F.lit(0xFFFFFFFF))
    around = lambda s: F.transform(
        F.sequence(F.lit(-1), F.lit(31)),
        lambda b: F.lit(s << 32).cast("bigint")
        + F.when(b < 0, half(s)).otherwise(
            half(s).bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))
        ),
    )
    filed = fps.select(F.explode(F.concat(around(0), around(1))).alias("run"), "fp")
    no_chunk = F.lit(0).alias("lo"), F.lit(0).alias("hi")
    first = written(
        filed.repartition("run")
        .sortWithinPartitions("run", "fp")
        .select("run", *no_chunk, "fp")
        .transform(arrow_map, _runs(run_limit), EDGES, records=10_000),
        "simhash-runs",
    )
    edges = first.filter("run is null").select("a", "b")
    long = first.filter("run is not null").select("run", "chunk", F.col("a").alias("fp"))
    chunks = long.groupBy("run").agg(F.max("chunk").alias("last"))
    crossed = (
        long.join(chunks, "run")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select(
            "run",
            F.least("chunk", "other").alias("lo"),
            F.greatest("chunk", "other").alias("hi"),
            "fp",
        )
        .repartition("run", "lo", "hi")
        .sortWithinPartitions("run", "lo", "hi", "fp")
        .transform(arrow_map, _runs(None), EDGES, records=10_000)
    )
    return edges.unionByName(crossed.select("a", "b"))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text_hash, fp, root and component_id.

    The root is the least fingerprint linked in any way, component_id the least id of the
    documents.
    """
    documents = written(fingerprints(documents, doc_id, text), "simhash-documents")
    distinct = written(
        documents.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = written(
        rooted.join(first, "root").select("fp", "root", "component_id"), "simhash-components"
    )
    return documents.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, without near-duplicates.

    Of each component the document of the least id stays, null being the greatest; of
    several with that id, the one with the least hash of its text, once.
    """
    found = near_duplicates(documents, doc_id, text)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    stay = found.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("__doc_id"), F.col("first.text_hash").alias("__text_hash")
    )
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("__doc_id")) & (
        F.xxhash64(text) == F.col("__text_hash")
    )
    kept = documents.join(stay.distinct(), same)
    return kept.dropDuplicates(["__doc_id", "__text_hash"]).select(*documents.columns)


def hex_fingerprint():
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))
