import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from fathom.llm.warc import (
    DATA, INDEX, build_record, locate_records, op2_warc, parse_record, read_records, write_archives,
)
from fathom.llm.zip_directory import BadArchive, data_start, members


def reader(raw):
    return lambda start, size: raw[start : start + size]


def listed(raw):
    return members(reader(raw), len(raw))


@pytest.mark.parametrize("comment", [b"", b"note PK\x05\x06 inside"])
@pytest.mark.parametrize("before", [b"", b"#!stub\n" * 9])
@pytest.mark.parametrize("zip64", [False, True])
def test_directory(comment, before, zip64):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        z.comment = comment
        for name, data in (("a.txt", b"alpha"), ("ü/b", b""), ("c", b"x" * 1000)):
            with z.open(name, "w", force_zip64=zip64) as f:
                f.write(data)
        z.writestr("packed", b"y" * 100, zipfile.ZIP_DEFLATED)
    raw = before + buffer.getvalue()
    got = listed(raw)
    assert [m.name for m in got] == ["a.txt", "ü/b", "c", "packed"]
    for m, data in zip(got, (b"alpha", b"", b"x" * 1000)):
        start = data_start(reader(raw), m)
        assert raw[start : start + m.size] == data and zlib.crc32(data) == m.crc32
    with pytest.raises(BadArchive):
        data_start(reader(raw), got[3])


def test_zip64_by_number_of_members():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(str(i)), b"")
    got = listed(buffer.getvalue())
    assert len(got) == 66_000 and got[-1].name == "65999"


def test_zip64_by_offset(tmp_path):
    path = tmp_path / "far.zip"
    with open(path, "wb") as f:
        f.truncate((1 << 32) + 5)  # a hole: takes no disk
    with zipfile.ZipFile(path, "a") as z:
        z.writestr("far", b"found")
    size = path.stat().st_size
    with open(path, "rb") as f:
        def read(start, n):
            f.seek(start)
            return f.read(n)

        (m,) = members(read, size)
        assert m.header >= 1 << 32 and read(data_start(read, m), m.size) == b"found"


@pytest.mark.parametrize("raw", [b"", b"PK", b"x" * 100, b"PK\x05\x06" + b"\xff" * 18])
def test_no_archive(raw):
    with pytest.raises(BadArchive):
        listed(raw)


def test_record():
    raw = build_record(7, "http://a/\r\nX: y", "é\r\n\r\n<p>".encode(), "ABC", None, False)
    record = parse_record(raw)
    assert record.payload == "é\r\n\r\n<p>".encode() and record.headers["warc-target-uri"] == "http://a/%0D%0AX: y"
    again = parse_record(build_record(8, None, b"12345", "ABC", 7, True))
    assert again.payload == b"" and again.http["content-length"] == "5" and again.headers["warc-refers-to"] == "<urn:page:7>"
    with pytest.raises(ValueError):
        parse_record(raw[:-1])


def expected(rows, least=0):
    largest = {}
    for page_id, html in rows:
        payload = (html or "").encode()
        group = largest.setdefault(payload, [])
        group.append(-1 if page_id is None else page_id)
    out = []
    for page_id, html in rows:
        payload = (html or "").encode()
        group = largest[payload]
        top, own = max(group), -1 if page_id is None else page_id
        revisit = len(payload) >= least and len(group) > 1 and own != top
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "same"), (2, "same"), (3, "same"), (4, None), (5, ""), (6, "é" * 50_000), (7, "<p>\r\n\r\n</p>"), (7, "<p>\r\n\r\n</p>"),
        (None, "same"), (None, "alone"), (8, "\0\x1f")]


@pytest.mark.parametrize("least", [0, 1, 5])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame([(i, "http://x/", h, "d", True) for i, h in ROWS],
                                  "page_id bigint, url string, html string, digest string, revisit boolean").repartition(3)
    manifest = write_archives(pages, str(tmp_path), least_bytes=least, archive_bytes=300)
    ranges = locate_records(manifest, range_bytes=200)
    got = read_records(ranges).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(ROWS, least)
    text = dict((h or "", None) for _, h in ROWS)
    assert {r.payload.decode() for r in got if r.record_type == "response"} == set(text)
    # Only archives of the manifest are read, and they are ordinary ZIP files.
    archives = [r.archive for r in manifest.collect()]
    assert len(archives) > 1
    for place in archives:
        with zipfile.ZipFile(place) as z:
            assert z.testzip() is None and z.namelist() == [DATA, INDEX]


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    manifest = write_archives(pages, str(tmp_path))
    assert manifest.count() == 0 and read_records(locate_records(manifest)).count() == 0


def test_query_on_given_pages(spark):
    from fathom.llm.common import table

    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.html) for r in table(spark, sf_dir, "pages").collect()]
    assert sorted(map(tuple, op2_warc(spark, sf_dir).collect()), key=str) == expected(rows)
