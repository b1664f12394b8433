"""WARC archives of gzip members: a writer and a splittable reader.

The writer makes one member per record; each task writes one file under a draft name and
moves it into place.  Records whose payloads are equal and at least ``LEAST_BYTES`` long
become one response, that of the smallest id, and revisits of it.

The reader gives tasks byte ranges, not files.  A task looks for the gzip magic in its
range, takes a place for a member if it decodes as a whole to a WARC record, and from
there goes from member to member.  It owns the records that start in its range, and reads
past the end of the range to finish the last of them.

Defined results: a null payload counts as empty, a null URL as none; a null id is never
the smallest unless all are null, and then all are responses; rows that repeat the
smallest id are responses too, so no record refers to itself; an empty table gives no
rows.  Only the named columns are used.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, new_folder, opened, written

LEAST_BYTES = 100
RANGE_BYTES = 4 << 20
READ_BYTES = 1 << 20
MAGIC = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"


def with_roles(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """The pages with digest, bytes, and ``refers_to`` where the record is a revisit."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.withColumns({"digest": F.sha2(payload, 256), "bytes": F.octet_length(payload)})
    firsts = (
        rows.filter(F.col("bytes") >= LEAST_BYTES)
        .groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min(page_id).alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col(page_id))
    return rows.join(firsts, F.col("digest") == F.col("first_digest"), "left").withColumn(
        "refers_to", F.when(revisit, F.col("first_id"))
    )


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, not yet compressed."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP + (payload if refers_to is None else b"")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is None:
        fields["WARC-Record-ID"] = "<urn:page>"
    if refers_to is not None:
        fields["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write one archive per task; the rows name path, bytes and records of each."""
    folder = new_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}.warc.gz"
        system, inner = opened(path)
        draft = f"{inner}.{task.taskAttemptId()}.tmp"
        records = size = 0
        out = None
        for batch in batches:
            columns = batch.to_pydict()
            for row in zip(*(columns[c] for c in batch.schema.names), strict=True):
                out = out or system.open_output_stream(draft)
                size += out.write(gzip_member(record(*row)))
                records += 1
        if out:
            out.close()
            system.move(draft, inner)
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": records}])

    rows = with_roles(
        pages.select(
            F.col(page_id).cast("bigint").alias("page_id"),
            F.coalesce(F.col(url), F.lit("")).alias("url"),
            F.col(html).alias("html"),
        ),
        "page_id",
        "html",
    )
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    files = rows.select("page_id", "url", payload.alias("payload"), "digest", "refers_to").transform(
        arrow_map, write, "path STRING, bytes BIGINT, records BIGINT"
    )
    return written(files, "warc-files")


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes


def parse(data: bytes) -> Record | None:
    """The record that the bytes hold, or None if they aren't exactly one."""
    if not data.startswith(b"WARC/1."):
        return None
    head, gap, block = data.partition(b"\r\n\r\n")
    if not gap:
        return None
    lines = [line.partition(": ") for line in head.decode("utf-8", "replace").split("\r\n")[1:]]
    fields = {name.lower(): value for name, _, value in lines}
    length = fields.get("content-length", "")
    if "warc-type" not in fields or not length.isdecimal() or len(block) != int(length) + 4:
        return None
    return Record(fields, block[: int(length)].partition(b"\r\n\r\n")[2])


class Source:
    """A file read in pieces, of which only the current stretch is kept."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.start, self.data = 0, b""

    def at(self, start: int, length: int) -> bytes:
        end = min(start + length, self.size)
        if not (self.start <= start and end <= self.start + len(self.data)):
            self.start = start
            self.data = self.file.read_at(min(max(length, READ_BYTES), self.size - start), start)
        return self.data[start - self.start : end - self.start]


def member(source: Source, start: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at start and the place after it; None if there is none."""
    unpacker = zlib.decompressobj(31)
    parts: list[bytes] = []
    at, step = start, 1 << 12
    while not unpacker.eof:
        piece = source.at(at, step)
        if not piece:
            return None
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error:
            return None
        if len(parts) == 1 and parts[0] and not b"WARC/1.".startswith(parts[0][:7]):
            return None
        at += len(piece)
        step = min(2 * step, READ_BYTES)
    return b"".join(parts), at - len(unpacker.unused_data)


def records(system: fs.FileSystem, path: str, start: int, end: int) -> Iterator[Record]:
    """The records that start at ``start`` or later, but before ``end``."""
    with system.open_input_file(path) as file:
        source = Source(file, file.size())
        at, chained = start, False
        while at < end:
            found = member(source, at) if source.at(at, 3) == MAGIC else None
            parsed = parse(found[0]) if found else None
            if parsed:
                yield parsed
                at, chained = found[1], True
            elif chained:
                raise ValueError(f"no record at byte {at} of {path}")
            else:
                stretch = source.at(at + 1, min(READ_BYTES, end - at + 1))
                place = stretch.find(MAGIC)
                if place >= 0:
                    at += 1 + place
                else:  # the magic may begin in the last two bytes
                    at += max(1, len(stretch) - 1)


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, start and end of the byte ranges of files given as path and bytes."""
    places = F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes))
    return files.select("path", "bytes", F.explode(places).alias("start")).select(
        "path", "start", F.least(F.col("bytes"), F.col("start") + range_bytes).alias("end")
    )


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record: page_id, url, record_type, refers_to, payload_digest and payload.

    ``payload_bytes`` is the length of the full payload, also of revisits, whose own
    payload is empty.  The payload of a response is checked against its digest.
    """

    def number(urn: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", urn)
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.to_pylist():
                rows, held = [], 0
                system, inner = opened(place["path"])
                for r in records(system, inner, place["start"], place["end"]):
                    digest = r.fields["warc-payload-digest"].removeprefix("sha256:")
                    response = r.fields["warc-type"] == "response"
                    if response and hashlib.sha256(r.payload).hexdigest() != digest:
                        raise ValueError(f"payload of {r.fields['warc-record-id']} is damaged")
                    rows.append(
                        {
                            "page_id": number(r.fields["warc-record-id"]),
                            "url": r.fields["warc-target-uri"],
                            "record_type": r.fields["warc-type"],
                            "refers_to": number(r.fields.get("warc-refers-to", "")),
                            "payload_digest": digest,
                            "payload_bytes": int(r.fields["x-payload-length"]),
                            "payload": r.payload,
                        }
                    )
                    held += len(r.payload)
                    if held > 8 * READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    places = ranges(files, range_bytes)
    return places.repartition(max(1, places.count()), "path", "start").transform(arrow_map, read, COLUMNS)


COLUMNS = (
    "page_id BIGINT, url STRING, record_type STRING, refers_to BIGINT, "
    "payload_digest STRING, payload_bytes BIGINT, payload BINARY"
)
SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)

ORACLE = """
    SELECT page_id, octet_length(encode(html)) AS payload_bytes,
           sha256(html) AS payload_digest,
           CASE WHEN octet_length(encode(html)) >= 100 AND page_id > first_id
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN octet_length(encode(html)) >= 100 AND page_id > first_id
                THEN first_id END AS refers_to
    FROM (SELECT page_id, coalesce(html, '') AS html,
                 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
          FROM pages)
"""
