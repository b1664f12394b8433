import hashlib
import os

import pytest
from pyarrow import fs

from millrace.llm import warc

PAGES = "page_id BIGINT, url STRING, html STRING"
BODY = "<p>" + "long enough to be a revisit " * 5 + "</p>"
ROWS = [
    (5, "http://a.example/5", BODY),
    (3, "http://a.example/3", BODY),
    (9, None, BODY),
    (None, "http://a.example/none", BODY),
    (4, "http://a.example/4", "short"),
    (1, "http://a.example/1", "short"),
    (7, "http://a.example/7\r\nX: y", None),
    (8, "http://a.example/8", ""),
    (10, "http://a.example/10", "é\n\r\n\r\nWARC/1.1\r\n" + "\x1f\x8b\x08" * 50),
]


def rows_of(df):
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)


def expected(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        equal = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = min(equal, default=None)
        revisit = len(data) >= 100 and page_id != first and first is not None
        out.append(
            (
                page_id,
                len(data),
                hashlib.sha256(data).hexdigest(),
                "revisit" if revisit else "response",
                first if revisit else None,
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_bytes", [37, 300, 1 << 20])
def test_every_record_is_read_once_whatever_the_ranges(spark, range_bytes):
    files = warc.write_archives(spark.createDataFrame(ROWS, PAGES))
    found = warc.read_archives(files, range_bytes)
    assert rows_of(found) == expected(ROWS)
    payloads = {r.page_id: bytes(r.payload) for r in found.collect() if r.record_type == "response"}
    assert payloads[10] == ROWS[-1][2].encode() and payloads[3] == BODY.encode()


def test_repeated_rows_of_the_smallest_id_are_responses(spark):
    rows = [(2, "u", BODY), (2, "u", BODY), (6, "u", BODY)]
    found = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, PAGES)))
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found.collect()) == [
        (2, "response", None),
        (2, "response", None),
        (6, "revisit", 2),
    ]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.read_archives(warc.write_archives(empty)).count() == 0
    rows = [(1, "u", "x", "mine", 3, "d", 4)]
    more = spark.createDataFrame(
        rows, PAGES + ", digest STRING, bytes INT, first_digest STRING, refers_to INT"
    )
    assert rows_of(warc.read_archives(warc.write_archives(more))) == expected([(1, "u", "x")])


def test_embedded_magic_and_damage(tmp_path):
    records = [
        warc.record(i, f"http://a.example/{i}", os.urandom(400), "0" * 64, None) for i in range(40)
    ]
    members = [warc.gzip_member(r) for r in records]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(members))
    size, local = path.stat().st_size, fs.LocalFileSystem()
    for step in (1, 97, 5000):
        found = []
        for start in range(0, size, step):
            found += warc.records(local, str(path), start, min(size, start + step))
            if step == 1 and start > 1500:
                break
        assert step == 1 or len(found) == 40
    broken = bytearray(b"".join(members))
    broken[len(members[0]) + 30] ^= 255
    path.write_bytes(broken)
    with pytest.raises(ValueError):
        list(warc.records(local, str(path), 0, size))
