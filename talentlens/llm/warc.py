"""Legacy archive converter: ARC files of version 1 and 2 to WARC 1.0.

An ARC file starts with a version block whose second line names the fields of the header
lines that follow; records are found by the lengths those lines declare.  Each becomes a
WARC record with a record id (a UUID of the archive's name and the record's offset), an
ISO time, a type, and SHA-1 digests of block and payload.  Of records with equal payloads
of at least ``least`` bytes the one with the smallest page id is a ``response``; the others
become ``revisit`` records that carry the HTTP header alone and refer to it.

Archives are whole files of about ``ARCHIVE_BYTES`` before compression, written and read
by Spark, so one task holds one archive at a time.  Payloads are never shuffled by digest:
only digests are grouped, and each archive gets the list of its own revisits.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import shared_path, stage
from .text import tidy

ARCHIVE_BYTES = 16 << 20
DATE = "20260101000000"
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: Least payload that may be a revisit.
LEAST = 0
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_NO_ID = (1 << 63) - 1


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _content(page_id, html: bytes) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", *([] if page_id is None else [f"X-Page-Id: {page_id}"]), f"Content-Length: {len(html)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + html


def arc_file(name: str, version: int, pages: list[tuple], date: str = DATE) -> bytes:
    """One ARC file of (page_id, url, html bytes) records; the last record's line end is left to the writer."""
    about = f"{version} 0 pages\n{FIELDS[version]}\n".encode()
    out, at = [], 0
    for i, (page_id, url, html) in enumerate([(None, f"filedesc://{name}", None), *pages]):
        content = about if i == 0 else _content(page_id, html)
        fields = [re.sub(r"\s", "%20", url or "") or "-", "0.0.0.0", date, "text/plain" if i == 0 else "text/html"]
        if version == 2:
            fields += ["200", "-" if i == 0 else hashlib.md5(content).hexdigest(), "-", str(at), name]
        head = " ".join([*fields, str(len(content))]).encode() + b"\n"
        out.append(head + content)
        at += len(head) + len(content) + 1
    return b"\n".join(out)


def read_arc(data: bytes, name: str = "") -> Iterator[tuple[int, dict, bytes]]:
    """(offset, fields, content) of every record after the version block."""
    fields, at = FIELDS[1].split(), 0
    first = True
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"{name}: the header line at {at} doesn't end")
        line = data[at:end].rstrip(b"\r").decode("utf-8", "surrogateescape")
        names = line.split(" ") if first else fields
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"{name}: no header line at {at}")
        size = int(values[-1])
        content = data[end + 1:end + 1 + size]
        if len(content) < size:
            raise ValueError(f"{name}: the record at {at} ends early")
        if first:
            first = False
            if not line.startswith("filedesc://"):
                raise ValueError(f"{name}: no version block")
            fields = content.split(b"\n")[1].decode().split()
        else:
            yield at, dict(zip(fields, values, strict=True)), content
        at = end + 1 + size


def _split(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload."""
    at = content.find(b"\r\n\r\n")
    return (content, b"") if at < 0 else (content[:at + 4], content[at + 4:])


def _header(lines: bytes, name: bytes) -> str | None:
    found = re.search(rb"^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", lines, re.M | re.I)
    return found[1].decode("utf-8", "replace") if found else None


def _int(value: str | None) -> int | None:
    return int(value) if value else None


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def _record(kind: str, id_: str, date: str, block: bytes, content_type: str, more: list[str]) -> bytes:
    time = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {id_}", f"WARC-Date: {time}", *more,
             f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def convert(arc: bytes, name: str, revisits: dict[int, str]) -> bytes:
    """The WARC file of an ARC file; ``revisits`` has the record each offset refers to.  The last line ends are left to the writer."""
    out = [_record("warcinfo", record_id(name, 0), DATE, b"format: WARC File Format 1.0\r\nsource: " + name.encode() + b"\r\n", "application/warc-fields", [f"WARC-Filename: {name}"])]
    for offset, fields, content in read_arc(arc, name):
        head, payload = _split(content)
        more = [f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
        kind, refers = ("revisit", revisits[offset]) if offset in revisits else ("response", None)
        if refers:
            more += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers}"]
        out.append(_record(kind, record_id(name, offset), fields["Archive-date"], head if refers else content, "application/http; msgtype=response", more))
    return b"\r\n\r\n".join(out)


def read_warc(data: bytes, name: str = "") -> Iterator[tuple[bytes, bytes]]:
    """(header lines, block) of every record."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"{name}: no record at {at}")
        head = data[at:end + 2]
        size = int(_header(head, b"Content-Length"))
        if end + 4 + size > len(data):
            raise ValueError(f"{name}: the record at {at} ends early")
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size


def _written(rows: DataFrame, path: str, line_end: str) -> None:
    """One gzip file for each row of (archive, value)."""
    (rows.write.partitionBy("archive").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", line_end).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("archive").cast("string").alias("archive"), "content")


def _plain(data: bytes) -> bytes:
    return zlib.decompress(data, 47) if data else b""


def write_arc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write (page_id, url, html) as ARC files, versions 1 and 2 in turn.  A null html is empty."""

    def run(batches):
        def archive(number, held):
            name = f"{uuid.uuid4().hex}-{number}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_file(name, 1 + number % 2, held)], pa.binary()).cast(pa.string())], names=["archive", "value"])

        held, size, number = [], 0, 0
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (html or "").encode()
                held.append((page_id, url, data))
                size += len(data) + 200
                if size >= archive_bytes:
                    yield archive(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield archive(number, held)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    _written(rows.mapInArrow(tidy(run), "archive string, value string"), path, "\n")


_INDEX = "archive string, offset long, record string, page_id long, n long, digest string"


def index_arc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the ARC files under ``path``, without its payload."""

    def run(batches):
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for offset, _, content in read_arc(_plain(data), name):
                    head, payload = _split(content)
                    rows.append((name, offset, record_id(name, offset), _int(_header(head, b"X-Page-Id")), len(payload), digest(payload)))
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["archive", "offset", "record", "page_id", "n", "digest"])

    return _files(spark, path).mapInArrow(tidy(run), _INDEX)


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST) -> None:
    """Convert all ARC files under ``arc_path`` to WARC files under ``warc_path``.

    A record without a page id comes after those with one; equal page ids are told apart by archive and offset.
    """
    index = stage(index_arc(spark, arc_path), "index")
    order = F.struct(F.coalesce("page_id", F.lit(_NO_ID)).alias("page"), "archive", "offset", "record")
    first = index.groupBy("digest", "n").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")).where((F.col("copies") > 1) & (F.col("n") >= least))
    revisits = (index.join(first, ["digest", "n"]).where(F.col("record") != F.col("first.record"))
                .groupBy("archive").agg(F.collect_list(F.struct("offset", F.col("first.record").alias("record"))).alias("revisits")))     # as many as an archive has records

    def run(batches):
        for batch in batches:
            for name, data, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                warc = convert(_plain(data), name, {r["offset"]: r["record"] for r in refers or ()})
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([warc], pa.binary()).cast(pa.string())], names=["archive", "value"])

    both = _files(spark, arc_path).join(revisits, "archive", "left").select("archive", "content", "revisits")
    _written(both.mapInArrow(tidy(run), "archive string, value string"), warc_path, "\r\n\r\n")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record, page_id, record_type, payload_bytes, payload_digest, refers_record) of the response and revisit records under ``path``.

    A response's size and digest come from its payload; a digest that its header doesn't state is an error.
    """

    def run(batches):
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for head, block in read_warc(_plain(data), name):
                    kind = _header(head, b"WARC-Type")
                    if kind not in ("response", "revisit"):
                        continue
                    http, payload = _split(block)
                    stated = (_header(head, b"WARC-Payload-Digest") or "").removeprefix("sha1:")
                    if kind == "response" and digest(payload) != stated:
                        raise ValueError(f"{name}: wrong payload digest of {_header(head, b'WARC-Record-ID')}")
                    rows.append((_header(head, b"WARC-Record-ID"), _int(_header(http, b"X-Page-Id")), kind,
                                 len(payload) if kind == "response" else _int(_header(http, b"Content-Length")), stated, _header(head, b"WARC-Refers-To")))
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                     names=["record", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_record"])

    return _files(spark, path).mapInArrow(tidy(run), "record string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_record string")


def digests(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as ARC files, convert them to WARC files, and tell what those hold.

    Null html is an empty payload; pages without an id, and pages that repeat, have a record each; an
    empty table gives no records; columns beside page_id, url and html are not archived.
    """
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    if pages.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    convert_archives(spark, arc, warc)
    records = read_archives(spark, warc)
    targets = records.where("record_type = 'response'").select(F.col("record").alias("refers_record"), F.col("page_id").alias("refers_to"))
    return (records.where("record_type = 'revisit'").join(targets, "refers_record", "left").unionByName(records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
