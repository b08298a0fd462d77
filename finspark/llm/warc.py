"""WARC records in ZIP-packaged archives (operator 2).

An archive is a ZIP file whose members are stored, not deflated: a WARC file
of one gzip member a record (``archive/data.warc.gz``) and a CDX index
(``indexes/index.cdx``). Stored members can be read in place: the reader
parses the end record, the ZIP64 locator and end record where there are any,
and the central directory, finds where the members' data begin, reads the
index lines, and then reads each record by its byte range. Nothing is
extracted.

Records with equal payloads are kept once: that of the smallest page id is
the response, the others are revisits that refer to it. Payload digests are
bare upper-case base32 SHA-1.

Archives are rows (name, content) of a table under the shared checkpoint
folder, so any task on any machine reads them; files on other storage come
the same way through Spark's ``binaryFile`` reader (:func:`archives_in`).
One task packs about ``ARCHIVE_BYTES`` at a time, whatever the table's size;
only digests and ids are grouped, never payloads.

Defined results: null html is the empty payload; empty payloads equal each
other; repeated page ids are written each, the response being chosen by id
and digest; a page without an id is a response of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored

ARCHIVE_BYTES = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Signatures of the ZIP format (fixed values).
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MOST32, MOST16 = 0xFFFFFFFF, 0xFFFF
#: A fixed moment: archives of equal pages are equal bytes.
DATE, DOS_DATE = "2000-01-01T00:00:00Z", 0x2821
RECORD = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"
RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                          ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                          ("payload", pa.binary())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP -------------------------------------------------------------------

def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ZIP64 records when asked for or needed."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        raw, at, crc = name.encode(), len(out), binascii.crc32(data)
        big = zip64 or len(data) >= MOST32 or at >= MOST32
        size = MOST32 if big else len(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        version = 45 if big else 20
        out += LOCAL + struct.pack("<HHHHHIIIHH", version, 0x800, 0, 0, DOS_DATE, crc, size, size, len(raw), len(extra))
        out += raw + extra + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if big else b""
        central += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", version, version, 0x800, 0, 0, DOS_DATE, crc, size, size,
                                         len(raw), len(extra), 0, 0, 0, 0, MOST32 if big else at) + raw + extra
    start, n = len(out), len(members)
    out += central
    big = zip64 or start >= MOST32 or n >= MOST16
    if big:
        end = len(out)
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(central), start)
        out += LOCATOR64 + struct.pack("<IQI", 0, end, 1)
    out += END + struct.pack("<HHHHIIH", 0, 0, min(n, MOST16), min(n, MOST16), len(central) if not big else MOST32,
                             start if not big else MOST32, 0)
    return bytes(out)


def members(read: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset, length) of the data of each stored member, from the
    central directory; ``read(offset, length)`` reads a range."""
    tail_at = max(0, size - 22 - MOST16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature can stand in a comment
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if (at64 := tail_at + at - 20) >= 0 and (loc := read(at64, 20))[:4] == LOCATOR64:
        end64 = read(struct.unpack_from("<Q", loc, 8)[0], 56)
        if end64[:4] != END64:
            raise ValueError("damaged ZIP64 end of central directory")
        n, length, start = struct.unpack_from("<QQQ", end64, 32)
    central, out, p = read(start, length), {}, 0
    for _ in range(n):
        if central[p:p + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", central, p + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", central, p + 20)
        local = struct.unpack_from("<I", central, p + 42)[0]
        name = central[p + 46:p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = central[p + 46 + n_name:p + 46 + n_name + n_extra]
        e = 0
        while e + 4 <= len(extra):  # the ZIP64 field has only the values that don't fit above
            kind, long = struct.unpack_from("<HH", extra, e)
            if kind == 1:
                q = e + 4
                if full == MOST32:
                    full, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                if packed == MOST32:
                    packed, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                if local == MOST32:
                    local = struct.unpack_from("<Q", extra, q)[0]
            e += 4 + long
        if method == 0 and not flags & 1:
            head = read(local, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"damaged local header of {name}")
            a, b = struct.unpack_from("<HH", head, 26)
            out[name] = (local + 30 + a + b, full)
        p += 46 + n_name + n_extra + n_comment
    return out


# --- WARC ------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, own: str, refers_to: int | None) -> bytes:
    """One gzip member: a resource-like response, or a revisit without payload."""
    kind = "response" if refers_to is None else "revisit"
    heads = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {own}')}>"),
             ("WARC-Date", DATE), ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url or "")), ("WARC-Payload-Digest", f"sha1:{own}"),
             ("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    body = payload
    if refers_to is not None:
        heads += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("X-Refers-To-Page-Id", str(refers_to))]
        body = b""
    heads += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", compresslevel=4, mtime=0)


def parsed(member: bytes) -> dict:
    """A record's fields; a response's length and digest are those of what is
    read, a revisit's those that its header states."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = raw[end + 4:end + 4 + int(head["Content-Length"])]
    own, response = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "response"
    if response and digest(body) != own:
        raise ValueError(f"damaged payload of page {head['X-Page-Id']}")
    return {"page_id": int(head["X-Page-Id"]) if head["X-Page-Id"] else None, "url": head["WARC-Target-URI"], "record_type": head["WARC-Type"],
            "payload_digest": own, "payload_bytes": len(body) if response else int(head["X-Payload-Length"]),
            "refers_to": None if response else int(head["X-Refers-To-Page-Id"]), "payload": body if response else None}


def archive(records: list[tuple[int, bytes]], zip64: bool = False) -> bytes:
    """The archive of (page_id, gzip member) records."""
    lines, at = [], 0
    for page_id, member in records:
        lines.append(f"{page_id} {json.dumps({'offset': at, 'length': len(member), 'filename': 'data.warc.gz'})}\n")
        at += len(member)
    return zip_stored([(DATA, b"".join(m for _, m in records)), (INDEX, "".join(lines).encode())], zip64)


def records(read: Callable[[int, int], bytes], size: int) -> Iterator[dict]:
    """All records of an archive, each read by its range."""
    where = members(read, size)
    at, length = where[INDEX]
    data, total = where[DATA]
    for line in read(at, length).decode().splitlines():
        x = json.loads(line.split(" ", 1)[1])
        if not 0 <= x["offset"] <= x["offset"] + x["length"] <= total:
            raise ValueError("index beyond the archive's data")
        yield parsed(read(data + x["offset"], x["length"]))


# --- Spark -----------------------------------------------------------------

def first_pages(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the revisits."""
    own = pages.filter(F.octet_length("html") >= least_bytes).select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha"))
    first = own.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return own.join(first, "sha").filter("page_id <> refers_to").select("page_id", "sha", "refers_to").distinct()


def write_archives(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The archives as rows (name, content) of a stored table."""
    p = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    rows = p.join(first_pages(p, least_bytes), ["page_id", "sha"], "left").select("page_id", "url", "html", "refers_to")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, kept, size = TaskContext.get().partitionId(), 0, [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"part-{task:06d}-{n:06d}.wacz"]), pa.array([archive(kept)], pa.binary())],
                                              names=["name", "content"])

        for batch in batches:
            for part in slices(batch, "html"):
                for i, url, html, refers_to in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    payload = html.encode("utf-8", "surrogatepass")
                    kept.append((i, record(i, url, payload, digest(payload), refers_to)))
                    size += len(kept[-1][1])
                    if size >= archive_bytes:
                        yield done()
                        n, kept, size = n + 1, [], 0
        if kept:
            yield done()

    return stored(rows.mapInArrow(pack, "name string, content binary"), "archives")


def archives_in(spark: SparkSession, path: str) -> DataFrame:
    """Archive files on any storage that Spark reads, as (name, content)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("name"), "content")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record (see ``RECORD``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = memoryview(content.as_buffer())
                rows = []
                for r in records(lambda a, n: bytes(raw[a:a + n]), len(raw)):
                    rows.append(r if with_payload else r | {"payload": None})
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    return archives.select("content").mapInArrow(run, RECORD)
