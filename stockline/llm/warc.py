"""Web archives: one gzip member per record, and a splittable reader.

Writing: every page becomes one WARC/1.1 record in a gzip member of its own.
Records whose payload was already stored under a smaller page id become
``revisit`` records without a body. Each task writes files under names that no
other attempt uses and returns them as rows; only the files returned by the
attempts that Spark counted are part of the archive, so retried or speculative
tasks leave no record twice.

Reading: a file is cut into byte ranges, one task row each. A task scans its
range for the gzip magic number, accepts a candidate only if what follows
inflates to a complete WARC header, and owns each record that *starts* inside
its range, reading beyond the end of the range where the record does. Records
are thus read once wherever the cuts fall, and no index is needed.

Defined cases: a null payload is an empty payload; a null page id is written
without an id and never preferred as the first of its group, a group without
any id holds only responses; rows that repeat the smallest id of their group
are responses too; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from stockline.llm.common import file_system

MAGIC = b"\x1f\x8b\x08"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_STARTS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")

MANIFEST = StructType([StructField("path", StringType()), StructField("size", LongType()),
                       StructField("records", LongType())])
RECORDS = StructType([
    StructField("page_id", LongType()), StructField("url", StringType()), StructField("payload_bytes", LongType()),
    StructField("payload_digest", StringType()), StructField("record_type", StringType()),
    StructField("refers_to", LongType()), StructField("record_id", StringType()), StructField("path", StringType()),
    StructField("offset", LongType())])
WITH_PAYLOAD = StructType([*RECORDS.fields, StructField("payload", BinaryType())])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{digest if page_id is None else page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: the headers, the HTTP headers, and the payload unless it is a revisit."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id, digest)}", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_urn(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_revisit_bytes: int = 0, file_bytes: int = 1 << 30, level: int = 5) -> list[tuple[str, int, int]]:
    """Write ``pages`` below ``folder`` and return ``(path, bytes, records)`` of each file.

    Payloads of at least ``min_revisit_bytes`` bytes are stored once. Files are
    closed at ``file_bytes``, so the returned list has a row per task or per
    gigabyte, whichever is more.
    """
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("same", F.when(F.length("payload") >= min_revisit_bytes, F.sha1("payload")))
    first = (own.filter("same is not null").groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("same", "first"))
    rows = own.join(first, "same", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def write(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out, path, size, count = None, "", 0, 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        out, path, size, count = fs.open_output_stream(f"{base}/{name}", compression=None), name, 0, 0
                    data = _member(record(row["page_id"], row["url"], row["payload"], row["refers_to"]), level)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= file_bytes:
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pylist([{"path": path, "size": size, "records": count}])
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pylist([{"path": path, "size": size, "records": count}])

    found = rows.mapInArrow(write, MANIFEST).collect()
    return [(f"{folder.rstrip('/')}/{r['path']}", r["size"], r["records"]) for r in found]


class _Window:
    """A file seen through one buffered chunk at a time."""

    def __init__(self, source, size: int, chunk: int = 1 << 18) -> None:
        self.source, self.size, self.chunk, self.base, self.data = source, size, chunk, 0, b""

    def at(self, offset: int) -> bytes:
        """Bytes from ``offset`` on: some if there are any, at least three unless the file ends."""
        inner = offset - self.base
        if not (0 <= inner and inner + len(MAGIC) <= len(self.data)):
            self.source.seek(offset)
            self.base, self.data, inner = offset, self.source.read(min(self.chunk, self.size - offset)), 0
        return self.data[inner:] if inner else self.data

    def find(self, start: int, end: int) -> int:
        """Offset of the first magic number that starts in ``[start, end)``, or -1."""
        while start < end:
            piece = self.at(start)
            hit = piece.find(MAGIC)
            if hit >= 0:
                return start + hit if start + hit < end else -1
            if start + len(piece) >= self.size:
                return -1
            start += max(1, len(piece) - len(MAGIC) + 1)
        return -1


def _inflate(window: _Window, offset: int) -> tuple[bytes, int] | None:
    """Content and length of the WARC record in the member at ``offset``; None if there is none."""
    opened, parts, at, known = zlib.decompressobj(31), [], offset, False
    try:
        while not opened.eof:
            if at >= window.size:
                return None
            piece = window.at(at)
            parts.append(opened.decompress(piece))
            at += len(piece)
            if not known:
                head = b"".join(parts)
                if len(head) >= len(_STARTS[0]):
                    if not head.startswith(_STARTS):
                        return None
                    known = True
                parts = [head]
    except zlib.error:
        return None
    content = b"".join(parts)
    return (content, at - len(opened.unused_data) - offset) if content.startswith(_STARTS) else None


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _parse(content: bytes, path: str, offset: int, with_payload: bool) -> dict | None:
    head, gap, rest = content.partition(b"\r\n\r\n")
    fields = _headers(head)
    if not gap or "warc-type" not in fields or "warc-record-id" not in fields or not fields.get("content-length", "").isdigit():
        return None
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"{path}: the record at {offset} is cut short")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        size, payload = int(_headers(http).get("content-length", 0)), None
    else:
        size = len(payload)
        if payload_digest(payload) != digest:
            raise ValueError(f"{path}: the payload of the record at {offset} does not match its digest")
    whole = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": whole("x-page-id"), "url": fields.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["warc-type"], "refers_to": whole("x-refers-to-page-id"),
            "record_id": fields["warc-record-id"], "path": path, "offset": offset} | ({"payload": payload} if with_payload else {})


def records_in_range(source, size: int, start: int, end: int, path: str = "", with_payload: bool = True):
    """The records that start in ``[start, end)`` of an open archive of ``size`` bytes."""
    window, at = _Window(source, size), start
    while (at := window.find(at, end)) >= 0:
        found = _inflate(window, at)
        row = found and _parse(found[0], path, at, with_payload)
        if row:
            yield row
            at += found[1]
        else:
            at += 1


def read_warc(spark: SparkSession, files: list[tuple[str, int, int]], with_payload: bool = False,
              range_bytes: int = 128 << 20) -> DataFrame:
    """All records of the archive ``files`` (as ``write_warc`` lists them), read by byte ranges.

    Ranges are ``range_bytes`` long, or shorter where that leaves cores without
    work; no result depends on their length.
    """
    schema = WITH_PAYLOAD if with_payload else RECORDS
    arrow = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()])
                       for f in schema.fields])
    total = sum(size for _, size, _ in files)
    step = max(1 << 20, min(range_bytes, total // (4 * spark.sparkContext.defaultParallelism) + 1))
    table = spark.createDataFrame(files, MANIFEST)
    ranges = table.filter("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(step))).alias("start"))
    tasks = max(1, sum(-(-size // step) for _, size, _ in files))

    def read(batches):
        rows, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                fs, path = file_system(r["path"])
                with fs.open_input_file(path) as source:
                    for row in records_in_range(source, r["size"], r["start"], min(r["size"], r["start"] + step), r["path"], with_payload):
                        rows.append(row)
                        held += len(row.get("payload") or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return ranges.repartition(tasks).mapInArrow(read, schema)
