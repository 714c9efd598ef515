"""WARC archives: written as gzip members, one for each record, and read by splits of byte ranges.

Every task of the reader gets a range of an archive and scans it for the first bytes of a gzip
member. Compressed data may hold those bytes by chance, so a candidate counts only if it decodes,
begins with the header of a WARC record and ends with a right checksum; the scan then goes on behind
the member. A task owns the records that start inside its range and reads on past its end to finish
the last. So archives of any size are read in parallel without an index.

Archives and ranges are opened with pyarrow's file systems, by the URI of the folder in
``spark.checkpoint.dir`` or any given. Their names and sizes come from Spark's own listing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import dealt, shared_path

SPLIT = 32 << 20
READ = 1 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"  # of every record, so that archives written again are the same
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_RECORD = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, path string, offset long")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and re.match(r"^\w+:/", path):  # file:/folder, as Hadoop prints it
        path = path.replace(":/", ":///", 1)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 record. A revisit has the HTTP head of the page and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _id(refers_to))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str):
    """Writes the rows of each task as one archive. It gets its name when it is whole, and a task
    that runs again puts the same records there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        name = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        draft = f"{root}/.draft-{uuid.uuid4().hex}"
        out, n = None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, first, revisit = (batch.column(i)[row].as_py() for i in range(5))
                if out is None:
                    where.create_dir(root, recursive=True)
                    out = where.open_output_stream(draft)
                out.write(_member(record(page_id, url, (html or "").encode(), first, revisit)))
                n += 1
        if out is not None:
            out.close()
            where.move(draft, name)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["records"])
    return run


def write(pages: DataFrame, folder: str, least: int = 0) -> str:
    """Write the pages (``page_id``, ``url``, ``html``) as archives below a folder and return it.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest id is a
    response and the others revisit it; rows that repeat that id are responses too. Smaller
    payloads are always responses. A null html is an empty payload, and a null id is never
    referred to: pages without id are responses if no page with an id has their payload. An empty
    table writes no archive.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    key = F.sha1(payload.cast("binary"))
    small = pages.select("page_id", key.alias("sha"), F.octet_length(payload).alias("size")).where(F.col("size") >= least)
    first = small.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = (small.select("page_id", "sha").join(first, "sha")
             .where("first IS NOT NULL AND (page_id IS NULL OR page_id <> first)")
             .select(F.col("page_id").alias("id"), F.col("sha").alias("id_sha"), "first").distinct())
    marked = pages.select("page_id", "url", "html", key.alias("sha"))
    marked = marked.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("id_sha")), "left")
    (marked.select("page_id", "url", "html", "first", F.col("first").isNotNull().alias("revisit"))
     .mapInArrow(_writer(folder), "records long").write.format("noop").mode("overwrite").save())
    return folder


class _Range:
    """The bytes of an archive from an offset on, read as they are asked for."""

    def __init__(self, source, start: int):
        self.source, self.base, self.data = source, start, b""

    def at(self, offset: int, size: int) -> bytes:
        """``size`` bytes from an offset that never goes back; fewer at the end of the archive."""
        if offset > self.base:
            self.data, self.base = self.data[offset - self.base:], offset
            if not self.data:
                self.source.seek(offset)
        while len(self.data) < size:
            more = self.source.read(max(READ, size - len(self.data)))
            if not more:
                break
            self.data += more
        return self.data[:size]


def _decode(data: _Range, offset: int) -> tuple[bytes, int] | None:
    """The record of the member at an offset, and where the member ends; None if there is none."""
    unpack, parts, size, used = zlib.decompressobj(31), [], 0, READ
    piece, done = data.at(offset, READ), 0
    try:
        while True:
            out = unpack.decompress(piece)
            parts.append(out)
            if size < 7 <= size + len(out) and not b"".join(parts).startswith(b"WARC/1."):
                return None
            size += len(out)
            done += len(piece) - len(unpack.unused_data)
            if unpack.eof:
                break
            used *= 2
            piece = data.at(offset, used)[done:]
            if not piece:
                return None
    except zlib.error:
        return None
    text = b"".join(parts)
    return (text, offset + done) if text.startswith(b"WARC/1.") and b"\r\n\r\n" in text else None


def records(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and record of every member of an archive that starts in a byte range."""
    source.seek(start)
    data, at = _Range(source, start), start
    while at < end:
        block = data.at(at, READ)
        hit = block.find(MAGIC)
        if hit < 0:
            if len(block) < READ:
                return
            at += len(block) - len(MAGIC) + 1
            continue
        at += hit
        if at >= end:
            return
        found = _decode(data, at)
        if found is None:
            at += 1
            continue
        yield at, found[0]
        at = found[1]


def parse(text: bytes) -> dict:
    """Fields of a record. The payload of a revisit is elsewhere; its size and digest are here."""
    head, _, block = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != said):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        value = fields.get(name, "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(value) if value else None

    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload,
            "payload_bytes": size, "payload_digest": said, "record_type": fields["WARC-Type"],
            "refers_to": number("WARC-Refers-To")}


def _reader(with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("path", pa.string()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                where, name = _open(path)
                rows, size = [], 0
                with where.open_input_file(name) as source:
                    for offset, text in records(source, start, end):
                        found = parse(text) | {"path": path, "offset": offset}
                        size += len(found["payload"] or b"") + 200
                        if not with_payload:
                            found["payload"] = None
                        rows.append(found)
                        if size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read(spark: SparkSession, folder: str, split: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives (``*.warc.gz``) in a folder: ``page_id``, ``url``,
    ``payload`` (null for revisits), ``payload_bytes`` and ``payload_digest`` of the full payload,
    ``record_type``, ``refers_to``, and where it is. A folder without archives gives no rows."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    ranges = (found.select("path", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long")))
                           .alias("i", "start"))
              .select("path", "start", (F.col("start") + split).alias("end")))
    return dealt(ranges, "path", "start").mapInArrow(_reader(with_payload), _RECORD)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder, and what reading them back gives."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    where, root = _open(folder)
    where.create_dir(root, recursive=True)
    write(pages, folder, least)
    return read(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
