"""WARC archives packaged as ZIP, written and read by many tasks.

A task writes its pages as WARC records, each a gzip member of ``archive/data.warc.gz``, with
one line per record in ``indexes/index.cdxj``; both are stored members of a ZIP file, so they
can be read in place. Reading takes the central directory of each archive (with ZIP64), the
index found there, and then ranges of records, many tasks to an archive. Nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import arrow_rows, join_keys, materialize, table
from fathom.llm.zip_directory import data_start, members
from fathom.session import shared_dir

#: An archive is closed when it has so many bytes; records are read in ranges of about so many.
ARCHIVE_BYTES, RANGE_BYTES = 1 << 28, 1 << 22
#: Archives that a task lists, and ranges that it reads, on average.
ARCHIVES_A_TASK, RANGES_A_TASK = 4, 2
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
#: The pages have no time of capture.
DATE = "1970-01-01T00:00:00Z"

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"

MANIFEST = "archive string, records bigint, bytes bigint"
RANGES = "archive string, start bigint, lengths array<bigint>"
READ = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _name(page_id: int | None) -> str:
    return f"<{_PAGE}{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.strip("<>").removeprefix(_PAGE)
    return int(number) if number else None


def _header_value(text: str) -> str:
    """Control characters cannot stand in a header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def build_record(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record of one page; a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8").split("\r\n")
    return first, {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse_record(raw: bytes) -> Record:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, headers = _headers(head)
    length = int(headers["content-length"])
    if not version.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    return Record(headers, _headers(http)[1], payload)


@contextmanager
def _opened(place: str):
    """(read, size) of a file in the shared folder, by its URI or path."""
    system, path = fs.FileSystem.from_uri(place)
    with system.open_input_file(path) as file:
        yield lambda start, size: file.read_at(size, start), file.size()


class _Writer:
    """One archive: records first, then their index; the directory comes last."""

    def __init__(self, folder: str) -> None:
        self.place = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(self.place)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self._out = system.open_output_stream(path)
        self._zip = zipfile.ZipFile(self._out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._data = self._zip.open(DATA, "w", force_zip64=True)
        self._lines: list[str] = []
        self.bytes = 0

    def add(self, page_id, url, kind: str, digest: str, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self._data.write(packed)
        entry = {"url": url, "type": kind, "digest": f"sha1:{digest}", "offset": self.bytes, "length": len(packed),
                 "filename": DATA.rpartition("/")[2]}
        self._lines.append(f"{_name(page_id)} {DATE} {json.dumps(entry)}\n")
        self.bytes += len(packed)

    def close(self) -> tuple[str, int, int]:
        self._data.close()
        with self._zip.open(INDEX, "w", force_zip64=True) as index:
            for line in self._lines:
                index.write(line.encode())
        self._zip.close()
        self._out.close()
        return self.place, len(self._lines), self.bytes


def _manifest(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"archive": [r[0] for r in rows], "records": [r[1] for r in rows], "bytes": [r[2] for r in rows]},
        schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
    )


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives of all pages below ``folder`` (reachable from every executor); their manifest.

    Of records with equal payloads of ``least_bytes`` or more, those with the largest id are
    responses and the others revisit them; the rest are responses. A null html is an empty
    payload, a null id is below all others, rows that repeat a response are responses again,
    an empty table gives an empty manifest; other columns are not read.

    Payloads are compared by digest on narrow rows, counted before they are shuffled; only
    digests that occur more than once meet the pages again, and pages are not shuffled for that
    unless there are very many of them. The manifest is a stored table: it
    names what finished tasks wrote, so archives of lost or repeated tasks are never read.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    long_enough = F.octet_length("html") >= least_bytes
    equal = rows.filter(long_enough).groupBy("digest").agg(
        F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").select(F.col("digest").alias("equal_digest"), "leader", F.lit(True).alias("again"))
    keyed = rows.withColumn("equal_digest", F.when(long_enough, F.col("digest")))
    marked = join_keys(keyed, materialize(equal), "equal_digest", "left").select(
        "page_id", "url", "html", "digest", "leader",
        (F.col("again").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))).alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page_id, url, text, hex_digest, leader, revisit = row
                digest = _base32(hex_digest)
                record = build_record(page_id, url, text.encode(), digest, leader, revisit)
                writer = writer or _Writer(folder)
                writer.add(page_id, url, "revisit" if revisit else "response", digest, record)
                if writer.bytes >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield _manifest(done)

    return materialize(arrow_rows(marked).mapInArrow(run, MANIFEST))


def locate_records(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``archive, start, lengths``: ranges of consecutive records, from directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with _opened(place) as (read, size):
                    listed = {m.name: m for m in members(read, size)}
                    begin = data_start(read, listed[DATA])
                    index = listed[INDEX]
                    lines = read(data_start(read, index), index.size).decode().splitlines()
                starts, lengths, room = [], [], 0
                for line in lines:
                    entry = json.loads(line.split(" ", 2)[2])
                    if not starts or room + entry["length"] > range_bytes:
                        starts.append(begin + entry["offset"])
                        lengths.append([])
                        room = 0
                    lengths[-1].append(entry["length"])
                    room += entry["length"]
                yield pa.RecordBatch.from_pydict(
                    {"archive": [place] * len(starts), "start": starts, "lengths": lengths},
                    schema=pa.schema([("archive", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]),
                )

    # A directory is small beside what it describes. The number of tasks is stated: the manifest
    # itself is so small that adaptive execution would take it for the work of one.
    tasks = -(-manifest.count() // ARCHIVES_A_TASK) or 1
    return materialize(arrow_rows(manifest.select("archive").repartition(tasks)).mapInArrow(run, RANGES))


def _checked(raw: bytes, with_payload: bool) -> dict:
    record = parse_record(zlib.decompress(raw, 31))
    headers, kind = record.headers, record.headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(record.http["content-length"])
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(record.payload).digest()).decode()
        if found != digest or len(record.payload) != size:
            raise ValueError(f"payload of {headers['warc-record-id']} differs from its digest")
    return {
        "page_id": _page(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": record.payload if with_payload and kind == "response" else None,
    }


_READ_TYPES = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def read_records(ranges: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record, its payload checked against the digest.

    Lengths and digests are those of the full payload, for revisits too; their ``payload`` is
    null. Ranges are dealt out evenly, a few to a task, whatever archive they are of.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with _opened(place) as (read, _):
                    raw, at, rows = read(start, sum(lengths)), 0, []
                for length in lengths:
                    rows.append(_checked(raw[at : at + length], with_payload))
                    at += length
                yield pa.RecordBatch.from_pylist(rows, schema=_READ_TYPES)

    tasks = -(-ranges.count() // RANGES_A_TASK) or 1
    return arrow_rows(ranges.repartition(tasks)).mapInArrow(run, READ)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_dir(spark))
    found = read_records(locate_records(manifest), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
