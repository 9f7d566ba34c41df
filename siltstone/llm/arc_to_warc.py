"""Legacy ARC archives to WARC, and back to rows.

An ARC file begins with a version block that names its records' header fields; version 1 has five, version 2 ten. Each
record is one header line with a declared length, and so many bytes. The converter parses these and synthesises what a
WARC record needs: an identifier (a name-based UUID of URL, date, page and place in the archive), an ISO timestamp, the type, and SHA-256
digests of block and payload. Of records with equal payloads of at least ``least`` bytes the one with the smallest page id
becomes the response, the others revisits that keep their HTTP head; smaller ones are all responses.

Files hold about ``FILE_BYTES`` of payload, one gzip member for each record, and are written under names of their own;
manifests name only those of tasks that ended well.

Nulls and edges: a null payload is empty; a null or blank URL becomes ``about:blank``, and blanks or control characters in
one are percent-encoded; a null page id is written as ``-`` and comes last in the order; repeated ids stay separate
records, of which one is the response; very long pages are records as others, and end their file; an empty table gives no
rows; other columns than page_id, url and html are not looked at, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import fresh_path, read_blob, spread, staged, text_chunks, write_blob

FILE_BYTES = 8 << 20
LEAST = 100
#: Fixed values of the ARC formats: the fields of a record's header line.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


class ArcRecord(NamedTuple):
    fields: dict[str, str]
    block: bytes


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def arc_line(version: int, url: str, ip: str, date: str, mime: str, status: str, checksum: str, offset: int, name: str, length: int) -> bytes:
    fields = [url, ip, date, mime, str(length)] if version == 1 else [url, ip, date, mime, status, checksum, "-", str(offset), name, str(length)]
    return (" ".join(fields) + "\n").encode()


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 siltstone\n{ARC_FIELDS[version]}\n\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", "200", "-", 0, name, len(body)) + body


def parse_arc(stream: io.BufferedIOBase) -> Iterator[ArcRecord]:
    """Records after the version block. The version block's own header line is that of its version too."""
    line = stream.readline()
    if not line:
        return
    if not line.startswith(b"filedesc://"):
        raise ValueError("an ARC file begins with its version block")
    body = stream.read(int(line.rsplit(b" ", 1)[1]))
    number, names, *_ = body.decode().split("\n")
    fields = names.split(" ")
    if fields != ARC_FIELDS.get(int(number.split(" ")[0]), "").split(" "):
        raise ValueError(f"unknown ARC version block: {number!r}, {names!r}")
    while line := stream.readline():
        if line == b"\n":
            continue
        values = line.decode().rstrip("\n").split(" ")
        if len(values) != len(fields):
            raise ValueError(f"{len(values)} header fields, not {len(fields)}: {line[:200]!r}")
        record = dict(zip(fields, values))
        length = int(record["Archive-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"{record['URL']}: {len(block)} of {length} bytes")
        yield ArcRecord(record, block)


def http_parts(block: bytes) -> tuple[bytes, bytes, str]:
    """An HTTP response's head (with its blank line), payload, and the page's id from its head."""
    head, _, payload = block.partition(b"\r\n\r\n")
    page = re.search(rb"\r\nX-Page-Id: (\S*)", head)
    return head + b"\r\n\r\n", payload, page[1].decode() if page else "-"


def record_id(url: str, date: str, page: str, place: str) -> str:
    """``place`` is the record's file and ordinal, which tell records of equal pages apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {date} {place} {url}')}>"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def convert(record: ArcRecord, refers_to: str | None, place: str = "", digest: bytes | None = None) -> bytes:
    """The WARC record of an ARC record; a revisit of ``refers_to`` if that is given. ``digest`` is the payload's, if known."""
    url, date = record.fields["URL"], record.fields["Archive-date"]
    head, payload, page = http_parts(record.block)
    block = head if refers_to else record.block
    headers = {
        "WARC-Type": "revisit" if refers_to else "response",
        "WARC-Record-ID": record_id(url, date, page, place),
        "WARC-Date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z",
        "WARC-Target-URI": url,
        "WARC-IP-Address": record.fields["IP-address"],
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Payload-Digest": f"sha256:{(digest or hashlib.sha256(payload).digest()).hex()}",
    }
    if refers_to:
        headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": refers_to}
    return warc_record(headers, block)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:100]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            headers[k] = v.strip()
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or len(block) != int(headers["Content-Length"]):
            raise ValueError(f"{headers.get('WARC-Record-ID')}: its declared length is wrong")
        yield headers, block


def write_arc_files(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """ARC files, of either version in turn, of ``pages(page_id, url, html)``; returns their paths."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        date, parts, size, files = "20240101000000", [], 0, 0
        name = f"{uuid.uuid4().hex}.arc.gz"

        def flush() -> pa.RecordBatch:
            nonlocal parts, size, files, name
            write_blob(f"{folder}/{name}", parts)
            out = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])
            parts, size, files, name = [], 0, files + 1, f"{uuid.uuid4().hex}.arc.gz"
            return out

        for batch in text_chunks(batches, "html", 1 << 20):
            payloads = pc.fill_null(batch.column("html"), "").cast(pa.large_binary()).to_pylist()
            for page, url, payload in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), payloads):
                version = 1 + files % 2
                if not parts:
                    parts.append(member(arc_version_block(version, name, date)))
                url = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", (url or "").strip()) or "about:blank"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'-' if page is None else page}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
                line = arc_line(version, url, "192.0.2.1", date, "text/html", "200", "-", size, name, len(block))
                parts.append(member(line + block + b"\n"))
                size += len(block)
                if size >= file_bytes:
                    yield flush()
        if parts:
            yield flush()

    return staged(pages.select("page_id", "url", "html").mapInArrow(write, "path string"), "arc-files")


def scan_arc_files(files: DataFrame) -> DataFrame:
    """(path, ordinal, page_id, record_id, bytes, digest) of every record."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for k, r in enumerate(parse_arc(gzip.GzipFile(fileobj=io.BytesIO(read_blob(path))))):
                    _, payload, page = http_parts(r.block)
                    rows.append((path, k, None if page == "-" else int(page), record_id(r.fields["URL"], r.fields["Archive-date"], page, f"{os.path.basename(path)}/{k}"), len(payload), hashlib.sha256(payload).digest()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()])], ["path", "ordinal", "page_id", "record_id", "bytes", "digest"])

    return staged(spread(files, "path").mapInArrow(scan, "path string, ordinal int, page_id long, record_id string, bytes long, digest binary"), "arc-records")


def write_warc_files(records: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Convert every scanned ARC file into a WARC file; returns their paths."""

    def run(table: pa.Table) -> pa.Table:
        refers = dict(zip(table.column("ordinal").to_pylist(), zip(table.column("refers").to_pylist(), table.column("digest").to_pylist())))
        source = table.column("path")[0].as_py()
        place = os.path.basename(source)
        name = f"{uuid.uuid4().hex}.warc.gz"
        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(source, "", "", place), "WARC-Date": "2024-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}
        parts = [member(warc_record(info, b"software: siltstone\r\nformat: WARC File Format 1.1\r\n"))]
        parts += [member(convert(r, refers[k][0], f"{place}/{k}", refers[k][1])) for k, r in enumerate(parse_arc(gzip.GzipFile(fileobj=io.BytesIO(read_blob(source)))))]
        write_blob(f"{folder}/{name}", parts)
        return pa.table({"path": [f"{folder}/{name}"]})

    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "path", "ordinal", "record_id")
    first = records.where(F.col("bytes") >= least).groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("digest").alias("same"), F.col("first.path").alias("p"), F.col("first.ordinal").alias("o"), F.col("first.record_id").alias("r"))
    marked = records.join(first, records["digest"] == first["same"], "left")
    refers = F.when((F.col("path") != F.col("p")) | (F.col("ordinal") != F.col("o")), F.col("r"))
    # Of few bytes that each stand for much work: dealt out by path, or they would be joined in one task.
    dealt = spread(marked.select("path", "ordinal", refers.alias("refers"), "digest"), "path")
    return staged(dealt.groupBy("path").applyInArrow(run, "path string"), "warc-files")


def read_warc_files(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, record_id, refers_id) of every HTTP record."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_id string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for h, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(read_blob(path)))):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    head, payload, page = http_parts(block)
                    size, digest = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]), h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"{h['WARC-Record-ID']}: its payload is damaged")
                    rows.append((None if page == "-" else int(page), size, digest, h["WARC-Type"], h["WARC-Record-ID"], h.get("WARC-Refers-To")))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), *[pa.string()] * 4])], [x.split()[0] for x in schema.split(", ")])

    return spread(files, "path").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """ARC files of ``pages``, converted to WARC files, read back: one row for each page."""
    spark = pages.sparkSession
    records = scan_arc_files(write_arc_files(pages, fresh_path(spark, "arc")))
    found = staged(read_warc_files(write_warc_files(records, fresh_path(spark, "warc"), least)), "warc-records")
    targets = found.where("refers_id IS NOT NULL").select(F.col("refers_id").alias("wanted")).distinct()
    named = found.where("record_type = 'response'").join(targets, F.col("record_id") == F.col("wanted"), "left_semi").dropDuplicates(["record_id"])
    named = named.select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    return found.join(named, found["refers_id"] == named["target"], "left").select(found["page_id"], "payload_bytes", "payload_digest", "record_type", "refers_to")
